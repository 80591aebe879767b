"""Secret scan with corpus-wide ownership frequency, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.common import stored

# Fixed values of the contract: the kinds in the order in which they are listed, each with its pattern,
# the group whose value is the secret, and the least length of that value. A run is dropped when it is
# too short; for runs that begin anywhere this is the same as a least count in the pattern.
KINDS = (
    ("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
# The method's own kind: long values of mixed letters and digits, kept when their owners are few.
OPAQUE = ("opaque", r"[A-Za-z0-9+/_-]{20,}={0,2}", 0, 20)
MIXED = r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])"
# A value that more owners or more repositories hold is a copied example.
MAX_OWNERS = 1
MAX_REPOSITORIES = 3


def _matches(text: Column, kind: tuple[str, str, int, int]) -> list[Column]:
    name, pattern, group, _ = kind
    return [F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias(f"m_{name}"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias(f"v_{name}")]


def _measured(kind: tuple[str, str, int, int]) -> Column:
    """Per match: length of the text before it since the last match, of the match, of its value, and a hash.

    The pieces between matches come from splitting by the same pattern, so both see the same matches.
    """
    name, pattern, _, _ = kind
    pieces = F.split(F.col("text"), pattern, -1)
    parts = F.arrays_zip(
        F.slice(F.transform(pieces, F.length), 1, F.size(f"m_{name}")).alias("gap"),
        F.transform(F.col(f"m_{name}"), F.length).alias("size"),
        F.transform(F.col(f"v_{name}"), F.length).alias("value_size"),
        F.transform(F.col(f"v_{name}"), lambda v: F.unhex(F.sha2(v, 256))).alias("value"),
        F.transform(F.col(f"v_{name}"), lambda v: v.rlike(MIXED)).alias("mixed"))
    return F.when(F.size(f"m_{name}") > 0, parts).alias(f"f_{name}")


def candidate_spans(documents: DataFrame, owner: Column, repository: Column) -> tuple[DataFrame, DataFrame]:
    """(all rows: ``place, doc_id``; candidates: ``place, doc_id, owner, repository, kind, rank, start, end, value``).

    Texts are read once; only lengths and hashes leave that scan. Places in a text are running sums of
    lengths over the matches of one document and kind.
    """
    kinds = (*KINDS, OPAQUE)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.monotonically_increasing_id().alias("place"), "doc_id", owner.alias("owner"),
        repository.alias("repository"), text.alias("text"))
    rows = rows.select("*", *[c for kind in kinds for c in _matches(F.col("text"), kind)])
    found = stored(rows.select("place", "doc_id", "owner", "repository", *map(_measured, kinds)), "secret-matches")
    parts = [
        found.select(
            "place", "doc_id", "owner", "repository", F.lit(name).alias("kind"), F.lit(rank).alias("rank"),
            F.lit(least).alias("least"), F.posexplode(f"f_{name}").alias("i", "m"))
        for rank, (name, _, _, least) in enumerate(kinds)]
    spans = parts[0]
    for part in parts[1:]:
        spans = spans.unionByName(part)
    through = Window.partitionBy("place", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    spans = spans.withColumn("end", F.sum(F.col("m.gap") + F.col("m.size")).over(through).cast("long"))
    spans = spans.filter((F.col("m.value_size") >= F.col("least")) & ((F.col("rank") < len(KINDS)) | F.col("m.mixed")))
    return found.select("place", "doc_id"), spans.select(
        "place", "doc_id", "owner", "repository", "kind", "rank", (F.col("end") - F.col("m.size")).alias("start"),
        "end", F.col("m.value").alias("value"))


def ownership(candidates: DataFrame) -> DataFrame:
    """``value, owners, repositories, uses`` of each distinct value over the corpus.

    Counted in three steps, each collapsed before its shuffle, so a value that a third of all rows hold
    moves one row per task.
    """
    by_repository = candidates.groupBy("value", "owner", "repository").agg(F.count(F.lit(1)).alias("uses"))
    by_owner = by_repository.groupBy("value", "owner").agg(
        F.count(F.lit(1)).alias("repositories"), F.sum("uses").alias("uses"))
    return by_owner.groupBy("value").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"), F.sum("uses").alias("uses"))


def scan_secrets(
    documents: DataFrame, owner: Column, repository: Column,
    max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied``.

    Base spans always stay. ``n_live`` counts base spans whose value few owners and repositories hold,
    ``n_copied`` those of widely copied examples. Opaque values that overlap no base span and are as rare
    as a live one are added to ``spans``. Null and empty texts have no spans; a null owner or repository is one
    of its own; repeated rows each get their spans. Other columns are ignored.
    """
    rows, candidates = candidate_spans(documents, owner, repository)
    candidates = stored(candidates, "secret-candidates")
    base = F.col("rank") < len(KINDS)
    in_text = Window.partitionBy("place").orderBy("start", "rank")
    over = F.max(F.when(base, F.col("end"))).over(in_text.rowsBetween(Window.unboundedPreceding, 0))
    under = F.min(F.when(base, F.col("start"))).over(in_text.rowsBetween(0, Window.unboundedFollowing))
    inside = (F.coalesce(over, F.lit(0)) > F.col("start")) | (F.coalesce(under, F.col("end")) < F.col("end"))
    apart = candidates.withColumn("inside", inside).filter(base | ~F.col("inside"))
    live = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    judged = apart.join(ownership(candidates), "value", "left").withColumn("live", live).filter(base | F.col("live"))
    span = F.struct("start", "rank", "kind", "end", "live").alias("span")
    # A row without a span for each document keeps those that have none.
    every = judged.select("place", "doc_id", span)
    every = every.unionByName(rows.select("place", "doc_id", F.lit(None).cast(every.schema["span"].dataType).alias("span")))
    grouped = every.groupBy("place", "doc_id").agg(F.array_sort(F.collect_list("span")).alias("spans"))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(spans: Column, condition) -> Column:
        return F.size(F.filter(spans, condition)).cast("long")

    def of_rank(rank: int):
        return lambda s: s["rank"] == rank

    grouped = grouped.withColumn("base", F.filter("spans", lambda s: s["rank"] < len(KINDS)))
    return grouped.select(
        "doc_id", *[number(F.col("base"), of_rank(rank)).alias(f"n_{kind[0]}") for rank, kind in enumerate(KINDS)],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
        number(F.col("base"), lambda s: s["live"]).alias("n_live"),
        number(F.col("base"), lambda s: ~s["live"]).alias("n_copied"))
