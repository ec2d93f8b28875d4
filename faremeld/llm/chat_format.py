"""Chat logs: snapshots that prefix longer conversations collapse, maximal ones are rendered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faremeld.llm.common import settle, table

#: Turn numbers of one chunk, within which positions and hashes are added up; turns of one rendered part.
CHUNK, PART = 256, 512
FIRST = -(1 << 62)


def turn_hashes(conversations: DataFrame) -> DataFrame:
    """(conv_id, role, text, pos, low, high): each turn's place from 1, and the rolling hash of all turns up to it.

    Repeated rows count once. Turns are ordered by number (null first), then
    role, then hash of the text. The rolling hash is a pair of sums of hashes of
    (place, role, text), so a conversation is added up chunk by chunk, and a
    long one is no single group.
    """
    clean = conversations.where("conv_id IS NOT NULL").select("conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(FIRST)).alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = clean.distinct().withColumn("chunk", F.expr(f"turn div {CHUNK}"))
    inside = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", F.md5("text"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    rows = settle(rows.withColumn("pos", F.row_number().over(inside).cast("long")))
    starts = rows.groupBy("conv_id", "chunk").agg(F.max("pos").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    rows = rows.join(starts.select("conv_id", "chunk", "start"), ["conv_id", "chunk"]).withColumn("pos", F.col("pos") + F.col("start"))
    digest = F.sha2(F.concat_ws("\x1f", F.col("pos").cast("string"), F.length("role").cast("string"), "role", "text"), 256)
    for name, at in (("low", 1), ("high", 16)):
        rows = rows.withColumn(name, F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(20,0)"))
    up = Window.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    own = settle(rows.select("conv_id", "chunk", "role", "text", "pos", *[F.sum(c).over(up).cast("decimal(38,0)").alias(c) for c in ("low", "high")]))
    ahead = own.groupBy("conv_id", "chunk").agg(*[F.max(c).alias(c) for c in ("low", "high")])
    ahead = ahead.select("conv_id", "chunk", *[F.coalesce(F.sum(c).over(before), F.lit(0)).cast("decimal(38,0)").alias(f"{c}_0") for c in ("low", "high")])
    joined = own.join(ahead, ["conv_id", "chunk"])
    return joined.select("conv_id", "role", "text", "pos", *[(F.col(c) + F.col(f"{c}_0")).cast("decimal(38,0)").alias(c) for c in ("low", "high")])


def collapse(hashed: DataFrame) -> DataFrame:
    """(conv_id, n_turns, copies) of the maximal conversations; of equal ones the smallest conv_id.

    A prefix that more rows have than conversations end with is a proper prefix
    of a longer one; an anti-join drops the conversations that end so.
    """
    key = ["n_turns", "low", "high"]
    ends = hashed.groupBy("conv_id").agg(F.max("pos").alias("n_turns"), F.max("low").alias("low"), F.max("high").alias("high"))
    finals = settle(ends.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies")))
    prefixes = hashed.select(F.col("pos").alias("n_turns"), "low", "high").groupBy(*key).agg(F.count("*").alias("rows"))
    proper = prefixes.join(finals, key).where("rows > copies").select(*key)
    return finals.join(proper, key, "left_anti").select("conv_id", "n_turns", "copies")


def render(hashed: DataFrame, maximal: DataFrame, part: int = PART) -> DataFrame:
    """(conv_id, part, n_turns, copies, rendered): the turns of each kept conversation, `part` turns a row."""
    said = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>\n"))
    rows = hashed.join(maximal, "conv_id").select("conv_id", "n_turns", "copies", F.expr(f"CAST((pos - 1) div {part} AS int)").alias("part"), F.struct("pos", said.alias("said")).alias("turn"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list("turn")), lambda x: x["said"]), "")
    return rows.groupBy("conv_id", "part", "n_turns", "copies").agg(whole.alias("rendered"))


def format_chats(conversations: DataFrame) -> DataFrame:
    """Maximal conversations, rendered.

    Needs conv_id, turn, role, text; other columns are not read. Null roles and
    texts are taken as empty; rows without a conv_id are left out; an empty
    table gives an empty one.
    """
    hashed = settle(turn_hashes(conversations))
    return render(hashed, collapse(hashed))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


def oracle() -> str:
    """The same rows in DuckDB, with whole prefixes instead of hashes."""
    return f"""
    WITH rows_once AS (SELECT DISTINCT conv_id, coalesce(turn, {FIRST}) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, md5(text)) AS pos FROM rows_once),
    convs AS (SELECT conv_id, list(md5(length(role) || ':' || role || text) ORDER BY pos) AS turns FROM placed GROUP BY conv_id),
    finals AS (SELECT array_to_string(turns, ',') AS said, min(conv_id) AS conv_id, count(*) AS copies, any_value(len(turns)) AS n_turns FROM convs GROUP BY 1),
    proper AS (SELECT DISTINCT array_to_string(turns[1:k], ',') AS said FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM convs)),
    kept AS (SELECT * FROM finals ANTI JOIN proper USING (said))
    SELECT p.conv_id, CAST((pos - 1) // {PART} AS INT) AS part, CAST(k.n_turns AS BIGINT) AS n_turns, k.copies,
      string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY pos) AS rendered
    FROM placed p JOIN kept k USING (conv_id) GROUP BY ALL"""
