"""Secrets in texts, and how widely each of them is owned over the corpus.

Candidates are found by patterns, with their places in code points. Every candidate
value is hashed, and the hashes are counted over distinct repositories and distinct
owners of the whole corpus: a value that many owners hold is a copied example, one
that few hold looks like a live credential of its owner. A live-looking candidate
gets one more span, of kind ``live``.

A null text counts as empty; texts without candidates give empty spans. Repeated
rows give repeated rows, and count once for ownership. A null repository or owner is
one value of its own. Values leave the task that finds them as hashes only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import write_table
from .common import whole_text

# Kind, pattern, group that holds the value, least length of the value.
KINDS = (
    (
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    # The runs are maximal, so a least length in the pattern drops the same matches.
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
LIVE = "live"
NAMES = [kind for kind, *_ in KINDS] + [LIVE]


def _hits(text: Column, number: int) -> Column:
    """Matches of one kind in order: place in the order, characters before the match
    since the last one, characters of the match, and the value's length and hash."""
    _, pattern, group, _ = KINDS[number]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    hits = F.transform(
        F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), value.alias("value")),
        lambda x, i: F.struct(
            F.lit(number).alias("kind"),
            i.alias("at"),
            F.char_length(x["gap"]).alias("gap"),
            F.coalesce(F.char_length(x["whole"]), F.lit(0)).alias("size"),
            F.coalesce(F.char_length(x["value"]), F.lit(0)).alias("value_size"),
            F.sha2(x["value"], 256).alias("value"),
        ),
    )
    # The piece after the last match has no match of its own.
    hits = F.filter(hits, lambda x: x["size"] > 0)
    return F.when(text.rlike(pattern), hits).otherwise(F.filter(hits, lambda x: F.lit(False)))


def scan_secrets(documents: DataFrame, keep: tuple[str, ...], text: str, repository: Column, owner: Column) -> DataFrame:
    """Per row: ``keep`` as k0, k1, ..., repository and owner, the hash of a text that
    has matches (else null), and its matches of all kinds. Written once."""
    hits = F.concat(*[_hits(F.col("text"), n) for n in range(len(KINDS))])
    rows = documents.select(
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)],
        repository.alias("repository"),
        owner.alias("owner"),
        whole_text(text).alias("text"),
    ).withColumn("hits", hits)
    return write_table(
        rows.select(
            *[f"k{i}" for i in range(len(keep))],
            "repository",
            "owner",
            F.when(F.size("hits") > 0, F.sha2("text", 256)).alias("content"),
            "hits",
        ),
        "secret-scan",
    )


def candidates(scanned: DataFrame) -> DataFrame:
    """content, kind, start, end, value: the matches that are long enough, once for
    each distinct text. Places are sums over the matches before, in a window that
    holds one text's matches of one kind."""
    hits = (
        scanned.filter("content IS NOT NULL")
        .select("content", F.explode("hits").alias("hit"))
        .select("content", "hit.*")
        .groupBy("content", "kind", "at")
        .agg(*[F.first(c).alias(c) for c in ("gap", "size", "value_size", "value")])
    )
    so_far = Window.partitionBy("content", "kind").orderBy("at")
    least = F.element_at(F.array(*[F.lit(n) for *_, n in KINDS]), F.col("kind") + 1)
    return (
        hits.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far))
        .withColumn("start", F.col("end") - F.col("size"))
        .filter(F.col("value_size") >= least)
        .select("content", "kind", "start", "end", "value")
    )


def ownership(scanned: DataFrame, found: DataFrame) -> DataFrame:
    """value, repositories, owners: over how many distinct ones each value is spread.
    Triples are made distinct before they are counted, so a hash that a third of the
    rows hold is a few rows for each task."""
    held = scanned.filter("content IS NOT NULL").select("content", "repository", "owner").distinct()
    triples = found.select("content", "value").distinct().join(held, "content").select("value", "repository", "owner").distinct()
    by_owner = triples.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("n"))
    owners = by_owner.groupBy("value").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("pairs"))
    by_repository = triples.select("value", "repository").distinct().groupBy("value").agg(F.count(F.lit(1)).alias("repositories"))
    return owners.join(by_repository, "value").select("value", "repositories", "owners")


def find_secrets(
    documents: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    repository: Column | None = None,
    owner: Column | None = None,
    live_repositories: int = 2,
    live_owners: int = 1,
) -> DataFrame:
    """``keep``, base_spans, all_spans and found, one row for each row of ``documents``.

    Spans are arrays of kind:start:end, end exclusive, by start and then kind.
    ``found`` has every candidate with its hash, repositories, owners and verdict.
    A value looks live while it is in ``live_repositories`` and with ``live_owners``
    at most; other values are copied examples.
    """
    repository = F.col("source") if repository is None else repository
    owner = F.col("source") if owner is None else owner
    scanned = scan_secrets(documents, keep, text, repository, owner)
    found = write_table(candidates(scanned), "secret-candidates")
    spread = write_table(ownership(scanned, found), "secret-ownership")
    live = (F.col("owners") <= live_owners) & (F.col("repositories") <= live_repositories)
    judged = found.join(spread, "value").withColumn("live", live)
    span = F.struct("start", "kind", "end", "value", "repositories", "owners", "live")
    digests = judged.groupBy("content").agg(F.array_sort(F.collect_list(span)).alias("found"))
    # Written, so that the join below can split a text that very many rows share.
    digests = write_table(digests, "secret-digests")
    names = F.array(*[F.lit(n) for n in NAMES])

    def joined(kinds) -> Column:
        return F.transform(kinds, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]))

    found_rows = F.coalesce("found", F.array().cast(digests.schema["found"].dataType))
    keys = [f"k{i}" for i in range(len(keep))]
    with_hits = scanned.filter("content IS NOT NULL").select("content", *keys).join(digests, "content", "left")
    without = scanned.filter("content IS NULL").select(*keys, F.lit(None).cast(digests.schema["found"].dataType).alias("found"))
    rows = with_hits.select(*keys, "found").unionByName(without).withColumn("found", found_rows)
    place = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    base = F.transform("found", place)
    marks = F.transform(
        F.filter("found", lambda s: s["live"]),
        lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), s["end"].alias("end")),
    )
    return rows.select(
        *[F.col(k).alias(c) for k, c in zip(keys, keep)],
        joined(base).alias("base_spans"),
        joined(F.array_sort(F.array_distinct(F.concat(base, marks)))).alias("all_spans"),
        "found",
    )
