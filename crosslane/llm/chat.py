"""Preference formatting of chosen and rejected conversations, in DataFrame functions only.

The longest common prefix of turns is rendered once as the prompt; what follows in either
conversation is a completion whose assistant texts alone count for the loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A turn is OPEN role CLOSE text END.
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"
TRAINED_ROLE = "assistant"


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit(CLOSE), t["text"], F.lit(END))), "")


def trained_spans(turns: Column) -> Column:
    """begin:end (characters of the rendered turns, end exclusive) of the assistant texts with their end marks, comma-joined."""
    fixed = len(OPEN) + len(CLOSE)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + fixed + F.char_length(t["role"])
        end = begin + F.char_length(t["text"]) + len(END)
        span = F.concat_ws(":", begin.cast("string"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(t["role"] == TRAINED_ROLE, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda a: F.array_join(a["spans"], ","))


def conversations(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, turns): each conversation's turns in order. Null roles and texts are empty ones, null ids are left out. One conversation
    is one row, so its size is that of the row it becomes."""
    one = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("pair_id")).agg(F.transform(F.sort_array(F.collect_list(one)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def formatted(pairs: DataFrame) -> DataFrame:
    """Prompt, completions and trained spans of (pair_id, a, b): the turns of the chosen and of the rejected conversation."""
    differs = F.exists("at", lambda i: F.get("a", i) != F.get("b", i))
    least = F.least(F.size("a"), F.size("b"))
    both = pairs.withColumn("at", F.when(least > 0, F.sequence(F.lit(0), least - 1)).otherwise(F.array().cast("array<int>")))
    same = F.when(differs, F.array_min(F.filter("at", lambda i: F.get("a", i) != F.get("b", i)))).otherwise(least)
    tail = lambda c: F.slice(c, F.col("prompt_turns") + 1, F.greatest(F.size(c), F.lit(1)))
    return both.withColumn("prompt_turns", same).select(
        "pair_id", "prompt_turns", rendered(F.slice("a", 1, F.col("prompt_turns"))).alias("prompt"),
        rendered(tail("a")).alias("chosen"), trained_spans(tail("a")).alias("chosen_spans"),
        rendered(tail("b")).alias("rejected"), trained_spans(tail("b")).alias("rejected_spans"),
    )


def preference_pairs(chosen: DataFrame, rejected: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row for each id in both tables of turns (id, turn, role, text): pair_id, prompt_turns, prompt, chosen, rejected
    and the trained spans of either completion.

    Turns are compared by role and text, in order of ``turn``, then role and text where it repeats; null turns come
    first. Equal conversations have empty completions; without a common first turn the prompt is empty. Null ids form no pair.
    """
    a = conversations(chosen, id_col).withColumnRenamed("turns", "a")
    b = conversations(rejected, id_col).withColumnRenamed("turns", "b")
    return formatted(a.join(b, "pair_id"))


def last_texts(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, reply): the text of each conversation's last turn: a maximum, combined before its shuffle, so no turns are gathered."""
    one = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("pair_id")).agg(F.max(one).alias("_m")).select("pair_id", F.col("_m.text").alias("reply"))


def with_next_reply(talks: DataFrame, replies: DataFrame) -> DataFrame:
    """(pair_id, a, b) of ``conversations`` and ``last_texts``: b is a with its last turn's text taken from the last turn of
    conversation id + 1; without that, the last turn goes, and a conversation of one turn forms no pair. A way to make
    rejected conversations that share all turns but the last. The turns stay where they were gathered."""
    last = F.element_at("turns", -1)
    swapped = F.when(F.col("reply").isNotNull(), F.array(F.struct(last["role"].alias("role"), F.col("reply").alias("text")))).otherwise(F.array())
    both = talks.join(replies.withColumn("pair_id", F.col("pair_id") - 1), "pair_id", "left")
    return both.select("pair_id", F.col("turns").alias("a"), F.concat(F.slice("turns", F.lit(1), F.size("turns") - 1), swapped).alias("b")).where(F.size("b") > 0)


def op8_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return formatted(with_next_reply(conversations(turns), last_texts(turns)))


_TURN = "'<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10)"
ORACLE = {
    "op8_preference_pairs": f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS INTEGER) AS i,
                  CAST(count(*) OVER (PARTITION BY conv_id) AS INTEGER) AS n FROM conversations),
a AS (SELECT conv_id, i, role, text FROM t),
b AS (SELECT conv_id, i, role, text FROM t WHERE i < n
      UNION ALL SELECT x.conv_id, x.i, x.role, y.text FROM t x JOIN t y ON y.conv_id = x.conv_id + 1 AND y.i = y.n WHERE x.i = x.n),
ids AS (SELECT DISTINCT a.conv_id FROM a JOIN b USING (conv_id)),
p AS (SELECT ids.conv_id, least((SELECT count(*) FROM a WHERE a.conv_id = ids.conv_id), (SELECT count(*) FROM b WHERE b.conv_id = ids.conv_id),
             coalesce((SELECT min(a.i) - 1 FROM a JOIN b ON a.conv_id = b.conv_id AND a.i = b.i WHERE a.conv_id = ids.conv_id AND (a.role, a.text) <> (b.role, b.text)), 1000000)) AS k FROM ids),
r AS (SELECT 'a' AS side, a.* FROM a UNION ALL SELECT 'b', b.* FROM b),
s AS (SELECT r.*, p.k, sum(CASE WHEN r.i > p.k THEN 13 + length(role) + length(text) ELSE 0 END) OVER (PARTITION BY side, r.conv_id ORDER BY r.i) AS upto FROM r JOIN p USING (conv_id)),
g AS (SELECT conv_id, side, k, coalesce(string_agg({_TURN}, '' ORDER BY i) FILTER (WHERE i <= k), '') AS prompt, coalesce(string_agg({_TURN}, '' ORDER BY i) FILTER (WHERE i > k), '') AS rest,
             coalesce(string_agg((upto - length(text) - 8) || ':' || upto, ',' ORDER BY i) FILTER (WHERE i > k AND role = 'assistant'), '') AS spans FROM s GROUP BY ALL)
SELECT x.conv_id AS pair_id, CAST(x.k AS INTEGER) AS prompt_turns, x.prompt, x.rest AS chosen, x.spans AS chosen_spans, y.rest AS rejected, y.spans AS rejected_spans
FROM g x JOIN g y ON x.conv_id = y.conv_id AND x.side = 'a' AND y.side = 'b'
"""
}
QUERIES = {"op8_preference_pairs": op8_preference_pairs}
