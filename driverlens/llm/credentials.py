"""Secrets in texts, told apart by who owns them over the whole corpus; table operations only.

Three kinds of candidates are matched in every whole text: ``assign`` (a secret-like name, then a value),
``access`` (access key ids) and ``hex`` (long hex strings). Each candidate's value is hashed, and the hashes are
counted by distinct repositories (an id column) and owners (a source column) over all rows. A value
that several owners have in several repositories, or that very many repositories have whoever owns them, is a
widely copied example; any other is specific to its owners and live-looking. Its span is added as ``example`` or ``live``.

Positions come from the pieces between the matches, as offsets in code points with exclusive
ends. Null text counts as empty. A null owner counts as one owner, a null id as one repository.
Rows are numbered in the written table of matches, so repeated rows stay apart; copies of a row
are no further repositories. Counting first reduces to distinct (hash, owner, repository), so a value
that fills a third of the corpus is spread over tasks. Extra columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driverlens.session import materialize

KINDS = ("assign", "access", "hex", "example", "live")
EXAMPLE_OWNERS, SHARED_REPOSITORIES = 2, 3  # so many owners and repositories in all make a value an example
COPIED_REPOSITORIES = 10  # and so many repositories do, even of one owner

# The patterns of the kinds.
NAMES = r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
ASSIGN = NAMES + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_PREFIX = "^" + NAMES + r"""["']?\x20*[:=]\x20*["']?"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"


def _cut(text: Column, pattern: str) -> Column:
    """Structs (gap, match): the characters before each leftmost match, since the one before, and its text."""
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern)
    pairs = F.arrays_zip(matches.alias("match"), F.transform(F.slice(gaps, F.lit(1), F.size(matches)), F.length).alias("gap"))
    empty = F.array().cast("array<struct<match:string,gap:int>>")
    return F.when(F.rlike(text, F.lit(pattern)), pairs).otherwise(empty)


def matches(docs: DataFrame, id: str = "doc_id", text: str = "text", owner: str = "source") -> DataFrame:
    """(row, id, owner, assign, access, hex): each text read once, its matches by kind; ``row`` is to be written down."""
    whole = F.coalesce(F.col(text), F.lit("")).alias("text")
    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), F.col(owner).alias("owner"), whole)
    return read.select("row", "id", "owner", *(_cut(F.col("text"), p).alias(k) for k, p in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX))))


def candidates(read: DataFrame) -> DataFrame:
    """One row per base span of ``matches``: row, id, owner, start, rank, kind, end, value_start, hash.

    Places are running sums over one text's matches of a kind.
    """
    line = Window.partitionBy("row").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    found = None
    for rank, kind in enumerate(KINDS[:3]):
        each = read.where(F.size(kind) > 0).select("row", "id", "owner", F.posexplode(kind).alias("place", "at")).select("row", "id", "owner", "place", "at.*")
        ended = each.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(line))
        value = F.regexp_replace("match", ASSIGN_PREFIX, "") if kind == "assign" else F.col("match")
        spans = ended.withColumn("value", value).where(F.length("value") >= 8).select(
            "row",
            "id",
            "owner",
            (F.col("end") - F.length("match")).alias("start"),
            F.lit(rank).alias("rank"),
            F.lit(kind).alias("kind"),
            "end",
            (F.col("end") - F.length("value")).alias("value_start"),
            F.sha2("value", 256).alias("hash"),
        )
        found = spans if found is None else found.unionByName(spans)
    return found


def ownership(found: DataFrame) -> DataFrame:
    """(hash, owners, repositories) of all candidate values of the corpus."""
    each = found.select("owner", "id", "hash").distinct()
    by_owner = each.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))


def judged(
    counted: DataFrame, owners: int = EXAMPLE_OWNERS, shared: int = SHARED_REPOSITORIES, copied: int = COPIED_REPOSITORIES
) -> DataFrame:
    """(hash, judged): ``example`` or ``live``, from owners and repositories."""
    widely = ((F.col("owners") >= owners) & (F.col("repositories") >= shared)) | (F.col("repositories") >= copied)
    return counted.select("hash", F.when(widely, "example").otherwise("live").alias("judged"))


def report(docs: DataFrame, id: str = "doc_id", text: str = "text", owner: str = "source", **bounds: int) -> DataFrame:
    """One row per document: id, ``base`` and ``added`` spans, arrays of (start, rank, kind, end); bounds as in ``judged``."""
    read = materialize(matches(docs, id, text, owner), "matches")
    found = materialize(candidates(read), "candidates")
    verdicts = judged(ownership(found), **bounds)
    rank = F.when(F.col("judged") == "example", KINDS.index("example")).otherwise(KINDS.index("live"))
    values = found.select("row", "value_start", "end", "hash").join(verdicts, "hash")
    added = _gathered(values.select("row", F.col("value_start").alias("start"), rank.alias("rank"), F.col("judged").alias("kind"), "end").distinct(), "added")
    spans = read.select("row", "id").join(_gathered(found, "base"), "row", "left").join(added, "row", "left")
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return spans.select(F.col("id").alias(id), *(F.coalesce(n, none).alias(n) for n in ("base", "added")))


def _gathered(spans: DataFrame, name: str) -> DataFrame:
    """The spans of each row, in order."""
    return spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias(name))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


REPORT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
pats(kind, rank, pat) AS (VALUES
  ('assign', 0, '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  ('access', 1, 'AKIA[A-Z0-9]+'), ('hex', 2, '[0-9a-f]+')),
cut AS (
  SELECT rid, doc_id, source, 'assign' AS kind, 0 AS rank, regexp_extract_all(text, (SELECT pat FROM pats WHERE rank = 0)) AS m, regexp_split_to_array(text, (SELECT pat FROM pats WHERE rank = 0)) AS g FROM d
  UNION ALL SELECT rid, doc_id, source, 'access', 1, regexp_extract_all(text, 'AKIA[A-Z0-9]+'), regexp_split_to_array(text, 'AKIA[A-Z0-9]+') FROM d
  UNION ALL SELECT rid, doc_id, source, 'hex', 2, regexp_extract_all(text, '[0-9a-f]+'), regexp_split_to_array(text, '[0-9a-f]+') FROM d),
each AS (SELECT rid, doc_id, source, kind, rank, unnest(m) AS m, unnest(list_slice(g, 1, len(m))) AS g, unnest(range(len(m))) AS i FROM cut WHERE len(m) > 0),
ends AS (SELECT *, CAST(sum(length(g) + length(m)) OVER (PARTITION BY rid, rank ORDER BY i) AS BIGINT) AS fin FROM each),
spans AS (
  SELECT rid, doc_id, source, kind, rank, fin - length(m) AS start, fin,
         CASE WHEN rank = 0 THEN regexp_replace(m, '^([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?', '') ELSE m END AS val
  FROM ends),
base AS (SELECT * FROM spans WHERE length(val) >= CASE rank WHEN 0 THEN 8 WHEN 1 THEN 16 ELSE 32 END),
owned AS (
  SELECT val, (count(DISTINCT coalesce(source, chr(0))) >= 2 AND count(*) >= 3) OR count(*) >= 10 AS copied
  FROM (SELECT DISTINCT val, source, doc_id FROM base) GROUP BY val),
added AS (
  SELECT DISTINCT rid, CASE WHEN copied THEN 'example' ELSE 'live' END AS kind, CASE WHEN copied THEN 3 ELSE 4 END AS rank, fin - length(val) AS start, fin
  FROM base JOIN owned USING (val)),
every AS (SELECT rid, kind, rank, start, fin FROM base UNION ALL SELECT rid, kind, rank, start, fin FROM added),
b AS (
  SELECT rid, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
         string_agg(kind || ':' || start || ':' || fin, ',' ORDER BY start, rank) AS ids
  FROM base GROUP BY rid),
e AS (SELECT rid, string_agg(kind || ':' || start || ':' || fin, ',' ORDER BY start, rank) AS spans FROM every GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
       sha256(coalesce(ids, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN b USING (rid) LEFT JOIN e USING (rid)
"""
