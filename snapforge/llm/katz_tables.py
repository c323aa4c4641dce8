"""Katz backoff of any order, in tables of n-grams that are evaluated recursively, in DataFrame operations only.

    P(w | h) = d_r c(h w) / c(h)    for an n-gram seen r times
             = bow(h) P(w | h')     for others; h' is h without its first word, bow(h) = what the discounts left over what P(. | h') leaves

down to P(w) of single words; formulas, discounts and tokens are those of katz, which evaluates order 2 in blocks. Here each order is a
table (h, w, p) and a table (h, bow), dealt out by h and kept in the shared folder. Only distinct n-grams are evaluated: from the
highest order down, each is joined with the tables and drops to the next order with its history's weight until it is found.
All counts are pre-aggregated, the heavy side of each join has a row an n-gram and the other a row a history, so Spark
can split a history with a large share of them.

Nulls, repeated rows, empty tables and other columns are as in katz.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .arrays import SPACE, lower_ascii, split_words
from .katz import HELD_OUT, K, discounts

#: Stands for a text's end, and as many times as needed before its first word; no word holds white space.
END = "\n"


def _held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % HELD_OUT[0] == HELD_OUT[1]


def _grams(rows: DataFrame, order: int) -> DataFrame:
    """rows with words to a row an n-gram: row, held_out, h (history, joined by spaces), w."""
    padded = F.concat(F.array_repeat(F.lit(END), order - 1), "words")
    at = F.posexplode("words").alias("i", "w")
    spread = rows.select("row", "held_out", padded.alias("padded"), at)
    return spread.select("row", "held_out", F.array_join(F.slice("padded", F.col("i") + 1, F.lit(order - 1)), " ").alias("h"), "w") if order > 1 else spread.select("row", "held_out", F.lit("").alias("h"), "w")


def _shorter(h: Column) -> Column:
    """A history without its first word; empty for one word."""
    return F.when(F.instr(h, " ") > 0, F.regexp_replace(h, "^[^ ]* ", "")).otherwise("")


def train(rows: DataFrame, order: int) -> tuple[float, list[DataFrame], list[DataFrame]]:
    """(probability of an unknown word, tables (h, w, p) of orders 1 to order, tables (h, bow) of orders 2 to order)."""
    seen = rows.where("not held_out")
    ones = common.stage(_grams(seen, 1).groupBy("h", "w").agg(F.count("*").alias("r")), "grams")
    tokens, once = ones.agg(F.coalesce(F.sum("r"), F.lit(0)), F.count_if(F.col("r") == 1)).first()
    unseen = min(0.5, max(once, 1) / (tokens + 1)) if tokens else 1.0
    tables, weights = [ones.select("h", "w", ((1 - unseen) * F.col("r") / max(1, tokens)).alias("p"))], []
    for n in range(2, order + 1):
        grams = common.stage(_grams(seen, n).groupBy("h", "w").agg(F.count("*").alias("r")), "grams")
        told = {r["r"]: r["n"] for r in grams.where(F.col("r") <= K + 1).groupBy("r").agg(F.count("*").alias("n")).collect()}  # at most K + 1
        d = discounts(np.array([told.get(r, 0) for r in range(1, K + 2)]))
        kept = F.element_at(F.array(*(F.lit(float(x)) for x in d)), F.least("r", F.lit(K)).cast("int"))
        kept = F.when(F.col("r") <= K, kept).otherwise(1.0)
        lower = tables[-1].select(F.col("h").alias("h2"), F.col("w").alias("w2"), F.col("p").alias("low"))
        with_low = grams.withColumn("kept", kept).join(lower, (_shorter(F.col("h")) == F.col("h2")) & (F.col("w") == F.col("w2")))
        history = with_low.groupBy("h").agg(F.sum("r").alias("c"), F.sum((1 - F.col("kept")) * F.col("r")).alias("freed"), F.sum("low").alias("seen"))
        applies = F.col("freed") > 0
        bottom = F.when(applies, F.col("c")).otherwise(F.col("c") + 1)
        left = F.when(applies, F.col("freed")).otherwise(1) / bottom
        history = common.stage(history.select("h", (left / F.greatest(1 - F.col("seen"), F.lit(1e-12))).alias("bow"), bottom.alias("bottom")), "histories")
        tables.append(common.stage(grams.withColumn("kept", kept).join(history, "h").select("h", "w", (F.col("kept") * F.col("r") / F.col("bottom")).alias("p")).repartition("h"), "probabilities"))
        weights.append(history.select("h", "bow"))
    return unseen, tables, weights


def evaluate(grams: DataFrame, unseen: float, tables: list[DataFrame], weights: list[DataFrame]) -> DataFrame:
    """Distinct n-grams (h, w) with log10p."""
    state = grams.select("h", "w", F.col("h").alias("at"), F.lit(0.0).alias("so_far"), F.lit(False).alias("done"))
    for n in range(len(tables), 0, -1):
        table = tables[n - 1].select(F.col("h").alias("h2"), F.col("w").alias("w2"), "p")
        state = state.join(table, (F.col("at") == F.col("h2")) & (F.col("w") == F.col("w2")), "left").drop("h2", "w2")
        here = ~F.col("done") & F.col("p").isNotNull()
        if n > 1:
            state = state.join(weights[n - 2].withColumnRenamed("h", "h2"), F.col("at") == F.col("h2"), "left").drop("h2")
            step = F.when(here, F.log10("p")).when(F.col("done"), 0.0).otherwise(F.log10(F.coalesce("bow", F.lit(1.0))))
        else:
            step = F.when(F.col("done"), 0.0).otherwise(F.log10(F.coalesce("p", F.lit(unseen))))
        state = state.select("h", "w", _shorter(F.col("at")).alias("at"), (F.col("so_far") + step).alias("so_far"), (F.col("done") | here).alias("done"))
    return state.select("h", "w", F.col("so_far").alias("log10p"))


def score(docs: DataFrame, order: int = 3) -> DataFrame:
    """doc_id, held_out, n_tokens, score of every row."""
    words = F.concat(split_words(lower_ascii(F.col("text")), SPACE), F.array(F.lit(END)))
    rows = common.id_text(docs).select("doc_id", F.monotonically_increasing_id().alias("row"), _held_out().alias("held_out"), words.alias("words"))
    rows = common.stage(rows, "tokens")
    unseen, tables, weights = train(rows, order)
    counted = common.stage(_grams(rows, order).groupBy("row", "h", "w").agg(F.count("*").alias("n")), "counted")
    told = evaluate(counted.select("h", "w").distinct(), unseen, tables, weights)
    summed = counted.join(told, ["h", "w"]).groupBy("row").agg(F.sum(F.col("n") * F.col("log10p")).alias("score"))
    return rows.join(summed, "row").select("doc_id", "held_out", F.size("words").cast("long").alias("n_tokens"), "score")
