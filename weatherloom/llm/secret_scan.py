"""Secrets in texts, told apart by who owns them in the whole corpus.

Candidates are found by patterns. Each candidate's hash is counted over distinct
owners and distinct repositories: a value that several owners or many repositories
have is a copied example, one that few places of one or two owners have and that looks
random is a live credential.

Only DataFrame functions are used. Spark has no function for the places of all
matches, so a text is split at the pattern: the lengths of what lies between the
matches, and of the matches, add up to their places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weatherloom.llm.scratch import materialise

# fixed values: kind, pattern, group of the value, least length of the value
KINDS = (
    (
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    # long runs that mix digits, capitals and small letters; added when owner-specific
    ("mixed", r"[A-Za-z0-9_-]{20,}", 0, 20),
)
BASE = 3
# a value is a copied example from so many distinct owners on, or from so many distinct
# repositories, whoever owns them
COPIED_OWNERS = 3
COPIED_REPOSITORIES = 20
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your|xxxx|1234567|abcdef"
LEAST_CHARACTERS = 6


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
    repository_col: str | None = None, copied_owners: int = COPIED_OWNERS,
    copied_repositories: int = COPIED_REPOSITORIES,
) -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied.

    A span is kind:start:end in code points, end exclusive, sorted by start, then by
    the kind's place in ``KINDS``. Spans of the first three kinds always stay; a
    "mixed" run is added when it overlaps none of them and is live. ``n_live`` and
    ``n_copied`` count the spans of either sort; the rest is neither.

    ``owner_col`` names who published a row, ``repository_col`` (default: the id)
    where it lies; null owners are one owner, null repositories one repository. A value
    of ``copied_owners`` owners or ``copied_repositories`` repositories is copied.
    Null and empty texts have no spans. Repeated rows are reported each and count
    as one repository. Other columns are not looked at.
    """
    scanned = _scanned(docs, id_col, text_col, owner_col, repository_col, False)
    spans = _judged(scanned, copied_owners, copied_repositories)
    return spans.select(F.col("id").alias(id_col), *spans.columns[2:])


def without_live_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
    repository_col: str | None = None, copied_owners: int = COPIED_OWNERS,
    copied_repositories: int = COPIED_REPOSITORIES,
) -> DataFrame:
    """The rows of ``docs``, all columns, that have no live credential."""
    scanned = _scanned(docs, id_col, text_col, owner_col, repository_col, True)
    live = _live(_spans(scanned), copied_owners, copied_repositories).where("live").select("row").distinct()
    return scanned.join(live, "row", "left_anti").select("record.*")


def _scanned(docs, id_col, text_col, owner_col, repository_col, whole):
    """The texts' matches; the text itself is not needed after this."""
    text = F.col(text_col)
    columns = [
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repository_col or id_col).cast("string"), F.lit("")).alias("repository"),
        F.concat(*(_matches(text, k) for k in range(len(KINDS)))).alias("matches"),
    ]
    if whole:
        columns.append(F.struct("*").alias("record"))
    return materialise(docs.select(*columns), "scanned")


def _matches(text: Column, k: int) -> Column:
    """(kind, number, characters before it since the last match, its length, value)."""
    _, pattern, group, _ = KINDS[k]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    zipped = F.arrays_zip(found.alias("found"), values.alias("value"), gaps.alias("gap"))
    rows = F.transform(
        F.slice(zipped, F.lit(1), F.size(found)),
        lambda m, i: F.struct(
            F.lit(k).alias("kind"), i.alias("number"), m["gap"].alias("gap"),
            F.length(m["found"]).alias("size"), m["value"].alias("value"),
        ),
    )
    none = F.array().cast("array<struct<kind:int,number:int,gap:int,size:int,value:string>>")
    return F.when(text.rlike(pattern), rows).otherwise(none)


def _spans(scanned: DataFrame) -> DataFrame:
    one = scanned.select("row", "owner", "repository", F.explode("matches").alias("m"))
    one = one.select("row", "owner", "repository", "m.*")
    order = Window.partitionBy("row", "kind").orderBy("number")
    past = order.rowsBetween(Window.unboundedPreceding, 0)
    end = (F.sum("gap").over(past) + F.sum("size").over(past)).cast("long")
    spans = one.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    long_enough = F.length("value") >= F.array(*(F.lit(k[3]) for k in KINDS))[F.col("kind")]
    varied = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Z]") & F.col("value").rlike("[a-z]")
    spans = spans.where(long_enough & ((F.col("kind") < BASE) | varied))
    # a mixed run may not overlap a base span: compare it with the furthest end before it
    # and the nearest start after it
    along = Window.partitionBy("row").orderBy("start", "kind")
    reached = F.max(F.when(F.col("kind") < BASE, F.col("end"))).over(
        along.rowsBetween(Window.unboundedPreceding, -1)
    )
    coming = F.min(F.when(F.col("kind") < BASE, F.col("start"))).over(
        along.rowsBetween(1, Window.unboundedFollowing)
    )
    free = (F.coalesce(reached, F.lit(0)) <= F.col("start")) & (F.coalesce(coming, F.col("end")) >= F.col("end"))
    spans = spans.withColumn("free", free).where((F.col("kind") < BASE) | F.col("free"))
    return materialise(
        spans.select("row", "owner", "repository", "kind", "start", "end", "value", F.md5("value").alias("hash")),
        "spans",
    )


def owners_of(spans: DataFrame) -> DataFrame:
    """(hash, owners, repositories): distinct ones, summed up from distinct rows.

    Three grouped counts instead of two distinct ones: nothing is expanded, and a
    hash that a third of the corpus has arrives as partial sums.
    """
    places = spans.groupBy("hash", "owner", "repository").count()
    by_owner = places.groupBy("hash", "owner").agg(F.count("*").alias("places"))
    by_repository = places.groupBy("hash", "repository").agg(F.count("*").alias("n"))
    owners = by_owner.groupBy("hash").agg(F.count("*").alias("owners"))
    return owners.join(by_repository.groupBy("hash").agg(F.count("*").alias("repositories")), "hash")


def _live(spans: DataFrame, copied_owners: int, copied_repositories: int) -> DataFrame:
    owned = owners_of(spans)
    random = ~F.col("value").rlike(PLACEHOLDER) & (
        F.size(F.array_distinct(F.split("value", ""))) >= LEAST_CHARACTERS
    )
    judged = spans.join(owned, "hash", "left")
    copied = (F.col("owners") >= copied_owners) | (F.col("repositories") >= copied_repositories)
    return judged.withColumn("copied", copied).withColumn("live", ~copied & random)


def _judged(scanned: DataFrame, copied_owners: int, copied_repositories: int) -> DataFrame:
    judged = _live(_spans(scanned), copied_owners, copied_repositories)
    shown = judged.where((F.col("kind") < BASE) | F.col("live"))
    names = F.array(*(F.lit(k[0]) for k in KINDS))
    text = F.concat_ws(":", names[F.col("kind")], F.col("start").cast("string"), F.col("end").cast("string"))
    per_row = shown.groupBy("row").agg(
        *(F.sum((F.col("kind") == k).cast("long")).alias(f"n_{KINDS[k][0]}") for k in range(BASE)),
        F.sort_array(F.collect_list(F.struct("start", "kind", text.alias("text")))).alias("list"),
        F.sum(F.col("live").cast("long")).alias("n_live"),
        F.sum(F.col("copied").cast("long")).alias("n_copied"),
    )
    base = F.concat_ws(",", F.filter("list", lambda s: s["kind"] < BASE)["text"])
    zero = F.lit(0).cast("long")
    joined = scanned.select("row", "id").join(per_row, "row", "left")
    return joined.select(
        "row", "id",
        *(F.coalesce(f"n_{KINDS[k][0]}", zero).alias(f"n_{KINDS[k][0]}") for k in range(BASE)),
        F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", F.col("list.text")).alias("spans"),
        F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_copied", zero).alias("n_copied"),
    )


def _oracle() -> str:
    found = "\nUNION ALL\n".join(
        f"""SELECT doc_id, source, {k} AS kind, '{name}' AS name, i,
       regexp_extract_all(text, '{_quoted(pattern)}')[i] AS found,
       regexp_extract_all(text, '{_quoted(pattern)}', {group})[i] AS value,
       list_sum(list_transform(regexp_split_to_array(text, '{_quoted(pattern)}')[1:i], lambda s: length(s)))
       + coalesce(list_sum(list_transform(regexp_extract_all(text, '{_quoted(pattern)}')[1:i - 1], lambda s: length(s))), 0)
         AS start
FROM (SELECT *, unnest(range(1, len(regexp_extract_all(text, '{_quoted(pattern)}')) + 1)) AS i
      FROM documents WHERE regexp_matches(text, '{_quoted(pattern)}'))"""
        for k, (name, pattern, group, _) in enumerate(KINDS)
    )
    least = ", ".join(str(k[3]) for k in KINDS)
    return rf"""
WITH found AS ({found}),
spans AS (
  SELECT *, start + length(found) AS "end" FROM found
  WHERE length(value) >= ([{least}])[kind + 1]
    AND (kind < {BASE} OR (regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Z]')
                           AND regexp_matches(value, '[a-z]')))
),
free AS (
  SELECT * FROM spans s WHERE kind < {BASE} OR NOT EXISTS (
    SELECT 1 FROM spans b WHERE b.doc_id = s.doc_id AND b.kind < {BASE}
      AND b.start < s."end" AND s.start < b."end")
),
owned AS (
  SELECT value, count(DISTINCT coalesce(source, '')) >= {COPIED_OWNERS}
                OR count(DISTINCT doc_id) >= {COPIED_REPOSITORIES} AS copied
  FROM free GROUP BY value
),
judged AS (
  SELECT f.*, copied, NOT copied AND NOT regexp_matches(f.value, '{PLACEHOLDER}')
         AND len(list_distinct(string_split(f.value, ''))) >= {LEAST_CHARACTERS} AS live
  FROM free f JOIN owned USING (value)
),
listed AS (
  SELECT doc_id,
         count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
         count(*) FILTER (kind = 2) AS n_hex,
         string_agg(name || ':' || start || ':' || "end", ',' ORDER BY start, kind) FILTER (kind < {BASE}) AS base,
         string_agg(name || ':' || start || ':' || "end", ',' ORDER BY start, kind) AS spans,
         count(*) FILTER (live) AS n_live, count(*) FILTER (copied) AS n_copied
  FROM judged WHERE kind < {BASE} OR live GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live,
       coalesce(n_copied, 0)::BIGINT AS n_copied
FROM documents d LEFT JOIN listed l ON d.doc_id = l.doc_id
"""


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''").replace('\\"', '"')


ORACLE = _oracle()
