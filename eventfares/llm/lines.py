"""Line dedup by rolling hashes over line hashes: repeated runs of lines go, wherever they begin and end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventfares.settings import keep

LONG_WORDS = 50  # a single line of more words is a passage of its own
ORDER = "decimal(38,0)"
REMOVED = "lines_removed"


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with its text rid of repeated runs of lines, and `lines_removed`.

    Lines end at a line feed. A rolling hash runs over the hashes of every two adjacent lines, and a
    chunk is a run of lines over which it repeats, so its boundaries lie where repetition ends, and an
    insertion moves none. Of two adjacent lines that are equal byte for byte to two others, wherever
    those are, the ones at the smallest (id, line) stay and the others go; so a chunk of two lines or
    more goes as a whole. So does a single line of more than `LONG_WORDS` words, which are runs of
    characters other than the space. Other single lines stay. A text all of whose lines go is empty.

    A null id ranks above all others. Rows that repeat an id have their lines at the same places, so
    those they have in common there all stay. A null text stays null, and an empty one is a single
    line. Other columns pass through, whatever their names; one called `lines_removed` is replaced.
    An empty table gives no rows.
    """
    # The columns of `docs` travel in one of ours, so that no name of theirs meets a name of ours.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{doc_id}`").cast("bigint").alias("id"),
        F.xxhash64(f"`{text}`").alias("hash"),
        F.col(f"`{text}`").alias("text"),
    )
    gone = _repeated(rows.select("id", "hash", "text"))
    gone = gone.groupBy(F.col("id").alias("g_id"), F.col("hash").alias("g_hash")).agg(F.collect_set("place").alias("gone"))
    found = rows.drop("text").join(gone, _same("g_id", "g_hash"), "left")
    touched = F.col("gone").isNotNull()
    whole = F.col("row").getField(text)
    # An untouched text is passed on; a cut one is split once, in a generator.
    found = found.select("row", "gone", F.explode(F.array(F.when(touched, F.split(whole, "\n", -1)))).alias("lines"))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    left = F.when(touched, F.array_join(F.transform(places, lambda p: F.get("lines", p)), "\n")).otherwise(whole)
    return found.select(
        *[(left if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns if c != REMOVED],
        F.when(touched, F.size("gone")).otherwise(0).cast("bigint").alias(REMOVED),
    )


def _same(doc_id: str, text_hash: str) -> Column:
    return F.col("id").eqNullSafe(F.col(doc_id)) & (F.col("hash") == F.col(text_hash))


def _repeated(rows: DataFrame) -> DataFrame:
    """The lines that go: `id, hash, place`."""
    marks = keep(_windows(rows), "windows")
    keys = marks.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    asked = (
        marks.join(keep(keys, "repeated-keys"), "key", "left_semi")
        .groupBy(F.col("id").alias("a_id"), F.col("hash").alias("a_hash"))
        .agg(F.collect_set(F.struct("place", "more")).alias("asked"))
    )
    # Windows whose hashes repeat are compared byte for byte: grouped by what they say.
    held = rows.join(asked, _same("a_id", "a_hash")).select("id", "hash", "asked", F.explode(F.array(F.split("text", "\n", -1))).alias("lines"))

    def said(at: Column) -> Column:
        line, after = F.get("lines", at["place"]), F.get("lines", at["place"] + 1)
        return F.struct(at["place"].alias("place"), at["more"].alias("more"), F.when(at["more"] == 1, F.concat(line, F.lit("\n"), after)).otherwise(line).alias("says"))

    windows = held.select("id", "hash", F.explode(F.transform("asked", said)).alias("window")).select("id", "hash", "window.*")
    windows = windows.withColumn("order", _order(F.col("id"), F.col("place")))
    # Places of equal windows come together once, without their text, which is in `digest` and told apart.
    marked = keep(windows.select("id", "hash", "place", "more", "order", F.sha2("says", 256).alias("digest")), "asked-windows")
    first = windows.groupBy("more", "says").agg(F.count("*").alias("n"), F.min("order").alias("first")).where("n > 1")
    first = keep(first.select("more", F.sha2("says", 256).alias("digest"), "first"), "repeated-windows")
    again = marked.join(first, ["more", "digest"]).where("order <> first")
    # Both lines of two go, or the one of a long line.
    return again.select("id", "hash", F.explode(F.sequence("place", F.col("place") + F.col("more"))).alias("place"))


def _windows(rows: DataFrame) -> DataFrame:
    """Every two adjacent lines and every long line: `id, hash, place, more, key`, the key of 64 bits."""
    lined = rows.where("text is not null").select("id", "hash", F.explode(F.array(F.split("text", "\n", -1))).alias("lines"))
    # Each step sits in a one-element generator, so that no later lambda repeats it per element.
    hashed = lined.select("*", F.explode(F.array(F.transform("lines", lambda line: F.xxhash64(line)))).alias("hashes"))

    def window(place: Column, more: int, key: Column) -> Column:
        return F.struct(place.alias("place"), F.lit(more).alias("more"), key.alias("key"))

    def rolled(at: Column) -> Column:
        return window(at, 1, F.xxhash64(F.get("hashes", at), F.get("hashes", at + 1)))

    def is_long(at: Column) -> Column:
        # Fewer characters cannot be so many words.
        line = F.get("lines", at)
        return (F.char_length(line) > 2 * LONG_WORDS) & (F.regexp_count(line, F.lit("[^ ]+")) > LONG_WORDS)

    n = F.size("lines")
    pairs = F.when(n > 1, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))
    long = F.filter(F.sequence(F.lit(0), n - 1), is_long)
    windows = F.concat(F.transform(pairs, rolled), F.transform(long, lambda at: window(at, 0, F.get("hashes", at))))
    return hashed.select("id", "hash", F.inline(windows))


def _order(doc_id: Column, place: Column) -> Column:
    """The order of (id, place) as one number of fixed width."""
    ranked = F.coalesce(doc_id.cast(ORDER), F.lit(str(1 << 63)).cast(ORDER))
    return (ranked * F.lit(str(1 << 32)).cast("decimal(10,0)") + place).cast(ORDER)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs)


OP9_SQL = """
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents
), n AS (
  SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM l
), p AS (
  SELECT doc_id, i, i + 1 AS last, line || chr(10) || after AS passage FROM n WHERE after IS NOT NULL
  UNION ALL
  SELECT doc_id, i, i AS last, line AS passage FROM n WHERE len(regexp_extract_all(line, '[^ ]+')) > 50
), r AS (
  SELECT *, row_number() OVER (PARTITION BY passage ORDER BY doc_id, i) > 1 AS again FROM p
), g AS (
  SELECT doc_id, i FROM r WHERE again UNION SELECT doc_id, last FROM r WHERE again
), d AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE g.i IS NULL), '') AS text, count(g.i) AS lines_removed
  FROM l LEFT JOIN g USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CASE WHEN documents.text IS NULL THEN NULL ELSE d.text END AS text,
  coalesce(lines_removed, 0) AS lines_removed
FROM documents LEFT JOIN d USING (doc_id)
"""
