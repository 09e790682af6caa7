"""Line deduplication with DataFrame functions only.

Lines are exploded, normalised and hashed; the documents of each hash are
counted over the whole corpus; lines of keys above the threshold are dropped
and the rest is put together again by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
STRIPPED = " \t\n\x0b\x0c\r"
MIN_DOCS = 3
MIN_CHARS = 20


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is. Pure ASCII takes the fast way."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(STRIPPED)))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """``docs`` with repeated lines dropped from the text, and ``n_lines``, ``n_dropped`` added.

    A line's key is the line stripped of ASCII white space with A-Z in lower
    case. A key of at least ``min_chars`` code points found in at least
    ``min_docs`` documents loses all its lines except in the largest id holding
    it. A document without a dropped line keeps its text as it is, null
    included (a null or empty text is one empty line). All other columns stay;
    columns named ``n_lines`` or ``n_dropped`` are replaced.

    Documents are told apart by id. Repeated rows are one document and get the
    same result; rows of one id with different texts are one document with both
    texts' lines. A row without an id counts for no key and keeps its lines.
    An empty table gives an empty result.

    Scale: lines travel as 16-byte hashes. Frequent keys are few beside the
    lines, so Spark broadcasts them below its own limit and else splits the
    skewed join; only positions of dropped lines, at most the document's own,
    are gathered per document.
    """
    text = F.col(text_col)
    lines = split_lines(text)
    rows = docs.select(
        F.col(id_col).alias("_llm_id"),
        F.xxhash64(text).alias("_llm_row"),
        F.posexplode(lines).alias("_llm_pos", "_line"),
    ).where(F.col("_llm_id").isNotNull() & (F.length("_line") >= min_chars))
    keyed = (
        rows.select("_llm_id", "_llm_row", "_llm_pos", line_key(F.col("_line")).alias("_key"))
        .where(F.length("_key") >= min_chars)
        .select(
            "_llm_id",
            "_llm_row",
            "_llm_pos",
            F.xxhash64("_key").alias("_h1"),
            F.xxhash64(F.lit(97), F.col("_key")).alias("_h2"),
        )
    )
    repeated = (
        keyed.select("_h1", "_h2", "_llm_id")
        .distinct()
        .groupBy("_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_docs"), F.max("_llm_id").alias("_last"))
        .where(F.col("_docs") >= min_docs)
        .drop("_docs")
    )
    dropped = (
        keyed.join(repeated, ["_h1", "_h2"])
        .where(F.col("_llm_id") < F.col("_last"))
        .groupBy("_llm_id", "_llm_row")
        .agg(F.collect_set("_llm_pos").alias("_gone"))
    )
    gone, parts = F.col("_gone"), split_lines(F.col(text_col))
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone)
    joined = F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n")
    mine = docs.withColumns({"_llm_id": F.col(id_col), "_llm_row": F.xxhash64(text)})
    own = [name for name in docs.columns if name not in ("n_lines", "n_dropped", text_col)]
    result = mine.join(dropped, ["_llm_id", "_llm_row"], "left").select(
        *(F.col(f"`{name}`") for name in own),
        F.when(gone.isNull(), F.col(text_col)).otherwise(joined).alias(text_col),
        F.size(parts).cast("bigint").alias("n_lines"),
        F.when(gone.isNull(), 0).otherwise(F.size(gone)).cast("bigint").alias("n_dropped"),
    )
    order = [name for name in docs.columns if name not in ("n_lines", "n_dropped")]
    return result.select(*(F.col(f"`{name}`") for name in order), "n_lines", "n_dropped")


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kept = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    return drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256")
    )


OP8_SQL = f"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      '{UPPER}', '{UPPER.lower()}') as key
  from lines),
repeated as (
  select key, max(doc_id) as last from keyed where length(key) >= {MIN_CHARS}
  group by key having count(distinct doc_id) >= {MIN_DOCS}),
judged as (
  select doc_id, pos, line, last is not null and doc_id < last as gone
  from keyed left join repeated using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from judged group by doc_id
"""
