"""Secret scans with corpus-wide ownership frequency, in DataFrame operations only.

Two kinds of candidates are found in every text: base matches of fixed patterns
and wider tokens (long, with letters and digits). Hashes of the candidates'
values are counted over distinct repositories and owners. A value that many
owners have, or many repositories of one owner, is a copied example; one that a
single owner has in a few repositories looks live, and the wider tokens among
those are added to the base spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.session import cut_lineage

#: kind, pattern, group of the value, least length of that group
BASE = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
TOKEN = ("token", r"[A-Za-z0-9+/_=-]{20,}", 0, 20)
MAX_OWNERS = 2
#: A live value is in at most so many repositories an owner; a larger number is an example that one owner copied.
MAX_REPOSITORIES = 10

_MARK, _STAND_IN = "\ue000", "\ue001"

def _pieces(text: Column, pattern: str) -> Column:
    """The text cut at its leftmost non-overlapping matches: length of every piece, and each match's text.

    Matches are wrapped in a mark that the text is first freed of (one code
    point for another, in no pattern).
    """
    marked = F.regexp_replace(F.translate(text, _MARK, _STAND_IN), pattern, f"{_MARK}$0{_MARK}")
    cut = F.transform(F.split(marked, _MARK, -1), lambda piece, i: F.struct(
        F.length(piece).alias("size"), F.when(i % 2 == 1, piece).alias("piece")))
    return F.when(F.rlike(text, F.lit(pattern)), cut).otherwise(F.array().cast("array<struct<size:int,piece:string>>"))


def _same_row(*order) -> Window:
    return Window.partitionBy("row").orderBy(*order).rangeBetween(Window.unboundedPreceding, Window.currentRow)


def candidates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
               repository_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows (row, id, key, owner, repository) of all documents, and spans (row, start, end, kind, value, is_base).

    ``row`` is unique and keeps equal rows apart, ``key`` is the hash of the
    text as given; a null text is empty. Without
    ``repository_col`` a document is a repository of its own. Wide spans need a
    letter and a digit and touch no base span. Positions are code points.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = cut_lineage(documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("key"),
        F.col(owner_col).cast("string").alias("owner"), F.col(repository_col or id_col).cast("string").alias("repository"),
        F.array(*[F.struct(F.lit(kind).alias("kind"), _pieces(text, pattern).alias("pieces"))
                  for kind, pattern, _, _ in (*BASE, TOKEN)]).alias("_kinds")))
    kinds = rows.select("row", F.explode("_kinds").alias("_k")).where("size(_k.pieces) > 0")
    pieces = kinds.select("row", "_k.kind", F.posexplode("_k.pieces").alias("_at", "_p"))
    before = F.sum("_p.size").over(Window.partitionBy("row", "kind").orderBy("_at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    value, least = F.col("_p.piece"), F.lit(0)
    for kind, pattern, group, size in (*BASE, TOKEN):
        value = F.when(F.col("kind") == kind, F.regexp_extract("_p.piece", pattern, group)).otherwise(value)
        least = F.when(F.col("kind") == kind, F.lit(size)).otherwise(least)
    found = pieces.withColumn("end", before.cast("int")).where("_p.piece is not null").select(
        "row", (F.col("end") - F.col("_p.size")).alias("start"), "end", "kind", value.alias("value"),
        (F.col("kind") != TOKEN[0]).alias("is_base"), least.alias("_least")).where("length(value) >= _least")
    reached = F.max(F.when(F.col("is_base"), F.col("end"))).over(_same_row(F.col("start")))
    ahead = F.min(F.when(F.col("is_base"), F.col("start"))).over(_same_row(F.col("start").desc()))
    touches = (F.coalesce("_reached", F.lit(0)) > F.col("start")) | (F.coalesce("_ahead", F.col("end")) < F.col("end"))
    spans = found.drop("_least").withColumns({"_reached": reached, "_ahead": ahead}).where(
        F.col("is_base") | (~touches & F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")))
    return rows.drop("_kinds"), cut_lineage(spans.drop("_reached", "_ahead"))


def ownership(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Per candidate hash: distinct owners and repositories that have it (null counts as one of each).

    Values repeated in a repository are merged before the shuffle, and each
    later count is of merged rows, so no group holds the copies of one value.
    """
    each = spans.select("row", F.xxhash64("value").alias("hash")).join(rows, "row").select("hash", "owner", "repository")
    per_owner = each.distinct().groupBy("hash", "owner").agg(F.count("*").alias("n_repositories"))
    return per_owner.groupBy("hash").agg(
        F.count("*").alias("n_owners"), F.sum("n_repositories").alias("n_repositories"))


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repository_col: str | None = None, max_owners: int = MAX_OWNERS,
         max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """One row per document: row, id, key, base, added and live spans, n_shared.

    ``base`` are the pattern matches, ``added`` the wide tokens whose value at
    most ``max_owners`` owners have, in at most ``max_repositories`` repositories
    each on average, ``live`` the base spans of such values;
    ``n_shared`` counts base spans of widely copied values. Spans are arrays of
    (start, end, kind, value) by start, then kind as listed; empty where nothing is found.
    """
    rows, spans = candidates(documents, id_col, text_col, owner_col, repository_col)
    kinds = F.array(*[F.lit(k[0]) for k in (*BASE, TOKEN)])
    span = F.struct("start", F.array_position(kinds, F.col("kind")).alias("order"), "end", "kind", "value")
    owned = (F.col("n_owners") <= max_owners) & (F.col("n_repositories") <= max_repositories * F.col("n_owners"))
    judged = spans.withColumn("hash", F.xxhash64("value")).join(ownership(rows, spans), "hash").groupBy("row").agg(
        F.collect_list(F.when(F.col("is_base"), span)).alias("base"),
        F.collect_list(F.when(~F.col("is_base") & owned, span)).alias("added"),
        F.collect_list(F.when(F.col("is_base") & owned, span)).alias("live"),
        F.sum((F.col("is_base") & ~owned).cast("long")).alias("n_shared"))
    lists = [F.coalesce(F.array_sort(name), F.array().cast("array<struct<start:int,order:bigint,end:int,kind:string,value:string>>"))
             .alias(name) for name in ("base", "added", "live")]
    return rows.join(judged, "row", "left").select(
        "row", "id", "key", *lists, F.coalesce("n_shared", F.lit(0).cast("long")).alias("n_shared"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each span replaced by ``mark``; spans are in order of their start and may overlap."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(acc, span):
        apart = span["start"] >= acc["at"]
        done = F.when(apart, F.concat(acc["done"], text.substr(acc["at"] + 1, span["start"] - acc["at"]), F.lit(mark))) \
            .otherwise(acc["done"])
        return F.struct(F.greatest(acc["at"], span["end"]).alias("at"), done.alias("done"))

    return F.aggregate(spans, state, step, lambda acc: F.concat(acc["done"], text.substr(acc["at"] + 1, F.length(text))))
