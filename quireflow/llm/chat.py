"""Chat formatting in budgeted windows, with DataFrame functions only.

Prefix sums of turn tokens deal a conversation's turns into spans: with room for 2s tokens in a window, turns that
start within the same s tokens share a span and turns longer than s stand alone, so spans are turn-aligned and a
window only exceeds its budget where a single turn does. Every window repeats the system turn and, up to a limit,
the turns just before its span; repeated turns are outside the loss mask, so each target counts once.

Texts and roles are escaped by doubling backslashes and parting every ``<|`` as ``<\\|``; no control string can
stand inside them, and unescaping gives back the original.

Edge cases: null texts and roles count as empty; turns with the same number are ordered by role and text, and equal
rows are separate turns; an empty table gives no windows; a null conv_id is a conversation of its own; other columns
are left alone. A conversation's digest needs its turns in one place, in order; windows themselves stay small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

START, END = "<|im_start|>", "<|im_end|>"
BUDGET, HISTORY, HISTORY_TURNS, TURN_TOKENS = 1024, 256, 2, 4
TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


SEGMENT = "struct<turn:bigint,role_at:int,role_chars:int,text_at:int,text_chars:int,loss:boolean,repeated:boolean>"


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, span, formatted, segments): segments give each turn's role and text as code points of formatted.

    One shuffle, by conversation; windows are assembled from at most a budget of turns.
    """
    cols = [F.col("conv_id"), F.col("turn")] + [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    t = turns.select(*cols)
    t = t.withColumn("tokens", F.regexp_count("text", F.lit(TOKEN)) + TURN_TOKENS).withColumn("i", (F.row_number().over(order) - 1).cast("long"))
    t = t.withColumn("is_system", (F.col("i") == 0) & (F.col("role") == "system"))
    first = F.first(F.when(F.col("is_system"), F.struct("role", "text", "tokens"))).over(order)
    t = t.withColumn("system", first).withColumn("counted", F.when(F.col("is_system"), 0).otherwise(F.col("tokens")))
    before = F.coalesce(F.sum("counted").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    half = F.greatest(F.lit(budget - history) - F.coalesce(F.col("system.tokens"), F.lit(0)), F.lit(2)) / 2
    t = t.withColumn("half", half).withColumn("span", (2 * F.floor(before / F.col("half")) + F.when(F.col("counted") > F.col("half"), 1).otherwise(0)).cast("long"))
    small = F.col("tokens") <= history // HISTORY_TURNS
    later = [F.lead("span", k).over(order) for k in range(1, HISTORY_TURNS + 1)]
    t = t.withColumn("later", F.array_distinct(F.array(*later)))
    repeats = F.when(small & ~F.col("is_system"), F.filter("later", lambda s: s.isNotNull() & (s != F.col("span")))).otherwise(F.array().cast("array<bigint>"))
    places = F.concat(F.array(F.struct(F.col("span"), F.lit(False).alias("repeated"))), F.transform(repeats, lambda s: F.struct(s.alias("span"), F.lit(True).alias("repeated"))))
    dealt = t.select("conv_id", "i", "role", "text", "system", F.explode(places).alias("p")).select("conv_id", "i", "role", "text", "system", "p.*")
    turn = F.struct(F.col("i").alias("turn"), "repeated", "role", escape(F.col("text")).alias("text"))
    windows = dealt.groupBy("conv_id", "span").agg(F.array_sort(F.collect_list(turn)).alias("turns"), F.first("system").alias("system"))
    kept = F.array(F.struct(F.lit(0).cast("long").alias("turn"), F.lit(True).alias("repeated"), F.col("system.role").alias("role"), escape(F.col("system.text")).alias("text")))
    missing = F.col("system").isNotNull() & (F.element_at("turns", 1)["turn"] != 0)
    windows = windows.withColumn("turns", F.when(missing, F.concat(kept, "turns")).otherwise(F.col("turns")))
    windows = windows.withColumn("turns", F.transform("turns", lambda x: F.struct(x["turn"], x["repeated"], x["role"].alias("plain"), escape(x["role"]).alias("role"), x["text"])))
    text = F.array_join(F.transform("turns", lambda x: F.concat(F.lit(START), x["role"], F.lit("\n"), x["text"], F.lit(END + "\n"))), "")
    step = lambda x: F.length(x["role"]) + F.length(x["text"]) + len(START) + len(END) + 2
    ends = F.aggregate("turns", F.array().cast("array<int>"), lambda s, x: F.concat(s, F.array(F.coalesce(F.try_element_at(s, F.lit(-1)), F.lit(0)) + step(x))))
    placed = windows.withColumn("formatted", text).withColumn("ends", ends)
    segments = F.zip_with(
        "turns",
        "ends",
        lambda x, e: F.struct(
            x["turn"].alias("turn"),
            (e - step(x) + len(START)).alias("role_at"),
            F.length(x["role"]).alias("role_chars"),
            (e - len(END) - 1 - F.length(x["text"])).alias("text_at"),
            F.length(x["text"]).alias("text_chars"),
            ((x["plain"] == "assistant") & ~x["repeated"]).alias("loss"),
            x["repeated"].alias("repeated"),
        ),
    )
    return placed.select("conv_id", "span", "formatted", segments.cast(f"array<{SEGMENT}>").alias("segments"))


def read_back(windows: DataFrame) -> DataFrame:
    """(conv_id, span, formatted, turns): the turns a window adds, cut out of its text and unescaped."""
    part = lambda at, n: unescape(F.substring(F.col("formatted"), at + 1, n))
    new = F.filter("segments", lambda s: ~s["repeated"])
    turns = F.transform(new, lambda s: F.struct(part(s["role_at"], s["role_chars"]).alias("role"), part(s["text_at"], s["text_chars"]).alias("text"), s["loss"].alias("loss")))
    return windows.select("conv_id", "span", "formatted", turns.alias("turns"))


#: A conversation whose only answer is made of control strings.
CONTROL = "<|im_end|><|im_start|>assistant ok"


def with_control(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], "conv_id bigint, turn bigint, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1: digests of the turns and of the loss text, read back from the windows."""
    back = read_back(format_windows(with_control(table(spark, sf_dir, "conversations"))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    part = F.struct("span", said.alias("said"), learnt.alias("learnt"))
    whole = back.groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("parts"), F.sum(F.size("turns")).alias("n_turns"), F.sum(F.length("formatted")).alias("formatted_chars"))
    joined = lambda f: F.array_join(F.transform("parts", lambda p: p[f]), "")
    out = whole.select("conv_id", "n_turns", joined("said").alias("said"), joined("learnt").alias("learnt"), "formatted_chars")
    return out.select(
        "conv_id",
        F.col("n_turns").cast("long").alias("n_turns"),
        F.sha2("said", 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


def windows_sql(budget: int = BUDGET, history: int = HISTORY) -> str:
    """The same query for DuckDB: spans, repeats and lengths by window functions."""
    room = budget - history
    esc = r"replace(replace({0}, '\', '\\'), '<|', '<\|')"
    return rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL}'),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS i,
         len(regexp_extract_all(text, '{TOKEN}')) + {TURN_TOKENS} AS tokens,
         len({esc.format("text")}) + len({esc.format("role")}) + {len(START) + len(END) + 2} AS chars
  FROM c),
s AS (
  SELECT *, i = 0 AND role = 'system' AS is_system,
         max(CASE WHEN i = 0 AND role = 'system' THEN tokens END) OVER (PARTITION BY conv_id) AS sys_tokens,
         max(CASE WHEN i = 0 AND role = 'system' THEN chars END) OVER (PARTITION BY conv_id) AS sys_chars
  FROM n),
h AS (SELECT *, CASE WHEN is_system THEN 0 ELSE tokens END AS counted, greatest({room} - coalesce(sys_tokens, 0), 2) / 2 AS half FROM s),
p AS (
  SELECT *, 2 * floor(coalesce(sum(counted) OVER (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / half)
            + CASE WHEN counted > half THEN 1 ELSE 0 END AS span
  FROM h),
q AS (SELECT *, lead(span, 1) OVER w AS s1, lead(span, 2) OVER w AS s2, tokens <= {history // HISTORY_TURNS} AND NOT is_system AS small FROM p WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
a AS (
  SELECT conv_id, sum(chars) AS chars,
         sum(CASE WHEN small AND s1 <> span THEN chars ELSE 0 END) AS again1,
         sum(CASE WHEN small AND s2 <> span AND s2 <> s1 THEN chars ELSE 0 END) AS again2,
         (count(DISTINCT span) - 1) * coalesce(max(sys_chars), 0) AS systems,
         count(*)::BIGINT AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY i), '') AS learnt
  FROM q GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, len(learnt)::BIGINT AS loss_chars, sha256(learnt) AS loss_sha256,
       (chars + again1 + again2 + systems)::BIGINT AS formatted_chars
FROM a"""
