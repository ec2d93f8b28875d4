"""Spelling variants: words one edit apart, found through sorted permuterm rotations."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faremeld.llm.common import discard, settle, table

#: Code points and occurrences of a word at least; a form has so many times the word's occurrences at least.
LETTERS, OCCURRENCES, TIMES = 7, 2, 10
#: Rotations of up to so many letters are written out; longer ones are named by two 127-bit hashes, so a word costs no square of its length.
WRITTEN = 40
MODULUS, BASE = (1 << 127) - 1, 0x9E3779B97F4A7C15F39CC0605CEDC835
#: Rotations that a task hands on together.
HANDED = 50_000


def vocabulary(docs: DataFrame, letters: int = LETTERS, occurrences: int = OCCURRENCES) -> DataFrame:
    """(word, n): the words of all texts after the planted slips, in JVM expressions.

    A run of letters whose checksum with its doc_id is a multiple of 31 loses
    one code point. Null text has no words; a null doc_id counts as empty text.
    """
    runs = F.regexp_extract_all("text", F.lit("([A-Za-zÀ-ÿ]+)"), F.lit(1))
    long_enough = F.filter(runs, lambda run: F.length(run) >= letters)
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(long_enough).alias("run"))
    lowered = found.select("id", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("run"))
    hashed = lowered.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    cut = F.expr("CAST(h % length(run) AS int)")
    word = F.when(F.col("h") % 31 == 0, F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, F.length("run")))).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).where(F.length("word") >= letters).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= occurrences)


def hashed_parts(word: str) -> tuple[list[int], list[int]]:
    """Hashes of a word's first k letters, and of its letters from k on, for every k."""
    before, powers = [0], [1]
    for letter in word:
        before.append((before[-1] * BASE + ord(letter) + 1) % MODULUS)
        powers.append(powers[-1] * BASE % MODULUS)
    whole, n = before[-1], len(word)
    return before, [(whole - before[k] * powers[n - k]) % MODULUS for k in range(n + 1)]


def rotations(word: str) -> Iterator[tuple[str, bool, bool]]:
    """(range, edited, first) of each rotation of the word with its end mark.

    A rotation that starts after the edited letter is in the range of the rest:
    every word that has another letter there starts with it, and the word
    without a letter there is the range itself. Of equal letters in a row, only
    the `first` stands for their deletion, so each pair meets once.
    """
    n = len(word)
    if n > WRITTEN:
        before, after = hashed_parts(word)
    for k in range(n + 1):
        yield f"{word[k:]}${word[:k]}" if n <= WRITTEN else f"{n}:{after[k]:x}${before[k]:x}", False, True
        if k < n:
            rest = f"{word[k + 1 :]}${word[:k]}" if n - 1 <= WRITTEN else f"{n - 1}:{after[k + 1]:x}${before[k]:x}"
            yield rest, True, k == 0 or word[k] != word[k - 1]


def near_words(words: DataFrame) -> DataFrame:
    """(id, n_near, best): for each of (id, word, n) with a word one edit away, how many there are and the best as (n, -id).

    `id` must order the words. Rotations are dealt and sorted by range, and
    each range's group is scanned: its words differ in one letter, so it has no
    more than the alphabet's letters, and one word more at most. Nobody's pairs
    are written; each word gets its group's count and best other member.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for number, word, n in zip(batch["id"].tolist(), batch["word"], batch["n"].tolist()):
                for rest, edited, first in rotations(word):
                    rows.append((rest, number, n, edited, first))
                    if len(rows) >= HANDED:
                        yield pd.DataFrame(rows, columns=["rest", "id", "n", "edited", "first"])
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=["rest", "id", "n", "edited", "first"])

    rotated = words.select("id", "word", "n").mapInPandas(run, "rest string, id long, n long, edited boolean, first boolean")
    group = Window.partitionBy("rest")
    own = F.struct("n", (-F.col("id")).alias("back"))
    ordered = group.orderBy(F.desc("edited"), F.desc("n"), "id")
    met = rotated.select("*", F.count("*").over(group).alias("members"), F.row_number().over(ordered).alias("place")).where("members > 1").withColumn("own", own)
    whole = F.max(F.when(~F.col("edited"), F.col("own"))).over(group)
    met = met.select(
        "id", "edited", "first", "place", whole.alias("whole"),
        F.count_if("edited").over(group).alias("replaced"),
        F.count_if(F.col("edited") & F.col("first")).over(group).alias("deleted"),
        F.max(F.when(F.col("edited") & (F.col("place") == 1), F.col("own"))).over(group).alias("best"),
        F.max(F.when(F.col("edited") & (F.col("place") == 2), F.col("own"))).over(group).alias("second"),
        F.max(F.when(F.col("edited") & F.col("first"), F.col("own"))).over(group).alias("longer"),
    )
    shorter = F.when(F.col("first"), F.col("whole"))
    replaced = F.when(F.col("place") == 1, F.col("second")).otherwise(F.col("best"))
    count = F.when(F.col("edited"), F.col("replaced") - 1 + shorter.isNotNull().cast("long")).otherwise(F.col("deleted"))
    best = F.when(F.col("edited"), F.greatest(replaced, shorter)).otherwise(F.col("longer"))
    return met.select("id", count.alias("count"), best.alias("best")).where("count > 0").groupBy("id").agg(F.sum("count").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) of (id, form): the last word that forms lead to.

    Each step multiplies the occurrences, so no chain is a circle or longer
    than their logarithm; every round follows twice as many steps.
    """
    now = settle(forms.select("id", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("id").alias("root"), F.col("root").alias("next"))
        stepped = settle(now.join(further, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        discard(now)
        if stepped.where("moved").isEmpty():
            return stepped.select("id", "root")
        now = settle(stepped.select("id", "root"))
        discard(stepped)


def spelling_variants(docs: DataFrame, times: int = TIMES, letters: int = LETTERS, occurrences: int = OCCURRENCES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (doc_id, text).

    A word's form is its near word (one letter inserted, deleted or replaced)
    of most occurrences, of several the first in code-point order, if it has
    `times` the word's. Repeated rows count each time; null and empty texts have
    no words; words of any length are compared whole; other columns are not read.
    """
    counted = settle(vocabulary(docs, letters, occurrences))
    words = settle(counted.orderBy("word").withColumn("id", F.monotonically_increasing_id()))
    discard(counted)
    near = near_words(words)
    joined = settle(words.select("id", "n").join(near, "id", "left").select("id", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("best.n") >= times * F.col("n"), F.col("best")).alias("best")))
    forms = joined.where("best IS NOT NULL").select("id", (-F.col("best.back")).alias("form"))
    last = roots(forms)
    names = words.select(F.col("id").alias("other"), F.col("word").alias("name"))
    led = forms.join(last, "id").join(names, F.col("form") == F.col("other")).select("id", "root", F.col("name").alias("form"))
    led = led.join(names, F.col("root") == F.col("other")).select("id", "form", F.col("name").alias("root"))
    out = words.select("id", "word").join(joined, "id").join(led, "id", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("best.n").alias("form_n"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
