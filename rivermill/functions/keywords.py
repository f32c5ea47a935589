"""Search words out of free text.

A text is cut into *atoms*: runs of letters, marks and digits of any script, lower-cased, and runs of
ideographs. A letter run is a word. A run of ideographs is split by longest match from the left against
a dictionary of words of any length; ideographs no dictionary word covers are words of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermill.operators import skew

# Classes of characters by their Unicode script and category.
HAN_CHARACTER = r"\p{IsHan}"
HAN = rf"{HAN_CHARACTER}+"
LETTERS = rf"[\p{{L}}\p{{M}}\p{{N}}&&[^{HAN_CHARACTER}]]+"


def single_words(text: Column | str) -> Column:
    """As ``atoms``, with every ideograph a word of its own: the words of a text without a dictionary."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(text), F.lit(f"({LETTERS}|{HAN_CHARACTER})"), F.lit(1))


def explode_single_words(df: DataFrame, text: str, out: str = "keyword") -> DataFrame:
    """One row per word of ``single_words``; a text without words stays as one row with a null word."""
    return df.select(*[c for c in df.columns if c != text], F.explode_outer(single_words(text)).alias(out))


def atoms(text: Column | str) -> Column:
    """All atoms of a text in order; an empty array for none, null for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(text), F.lit(f"({LETTERS}|{HAN})"), F.lit(1))


def explode_atoms(df: DataFrame, text: str, out: str = "atom") -> DataFrame:
    """One row per atom; a text without atoms stays as one row with a null atom."""
    return df.select("*", F.explode_outer(atoms(text)).alias(out))


def register_sql(spark: SparkSession, name: str = "kw_split") -> None:
    """Registers the split as a table function: ``FROM t LEFT JOIN LATERAL kw_split(t.text) ON TRUE``.

    The function is SQL itself, so Spark inlines it; it takes no dictionary.
    """
    pattern = f"({LETTERS}|{HAN_CHARACTER})"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(phrase STRING) RETURNS TABLE(keyword STRING) "
        f"RETURN SELECT word FROM explode(regexp_extract_all(lower(phrase), r'{pattern}', 1)) AS t(word)"
    )


def is_han(atom: str) -> Column:
    return F.col(atom).rlike(f"^{HAN}$")


def han_words(runs: DataFrame, dictionary: DataFrame | None, run: str = "atom") -> DataFrame:
    """Words of each distinct run of ideographs as ``(run, words)``.

    All substrings of the lengths of dictionary words are looked up under a 128-bit hash of their run, so what is
    shuffled grows with the run and not with its square. Then each run is walked from the left, the longest word first.
    """
    distinct = runs.select(F.col(run).alias("run")).distinct()
    if dictionary is None:
        return distinct.select("run", F.split("run", "").alias("words"))
    words = dictionary.select("word").filter(F.length("word") > 0).distinct()
    # One number comes to the driver: the length of the longest word.
    longest = words.agg(F.max(F.length("word"))).first()[0] or 1
    named = distinct.withColumn("id", F.struct(F.xxhash64("run"), F.xxhash64(F.lit(1), "run")))
    places = named.select("id", "run", F.posexplode(F.split("run", "")).alias("at", "_"))
    sizes = F.sequence(F.lit(1), F.least(F.lit(longest), F.length("run") - F.col("at")))
    grams = places.select("id", "at", F.explode(F.transform(sizes, lambda n: F.substring("run", F.col("at") + 1, n))).alias("word"))
    known = grams.join(words, "word", "left_semi").groupBy("id", "at").agg(F.max(F.length("word")).alias("size"))
    found = known.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", "size"))).alias("found"))

    def walk(acc: Column, match: Column) -> Column:
        free = match["at"] >= acc["next"]
        return F.struct(
            F.when(free, F.concat(acc["taken"], F.array(match))).otherwise(acc["taken"]).alias("taken"),
            F.when(free, match["at"] + match["size"]).otherwise(acc["next"]).alias("next"),
        )

    start = F.struct(F.array().cast("array<struct<at:int,size:int>>").alias("taken"), F.lit(0).alias("next"))
    end = F.array(F.struct(F.length("run").alias("at"), F.lit(0).alias("size")))

    def spoken(taken: Column) -> Column:
        """The taken words, each after the single ideographs since the one before."""

        def piece(match: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(taken, i - 1)["at"] + F.get(taken, i - 1)["size"]).otherwise(0)
            alone = F.substring("run", before + 1, match["at"] - before)
            own = F.substring("run", match["at"] + 1, match["size"])
            return F.filter(F.concat(F.split(alone, ""), F.array(own)), lambda w: w != "")

        return F.flatten(F.transform(taken, piece))

    split = named.join(found, "id", "left")
    taken = F.concat(F.aggregate(F.coalesce("found", F.array().cast("array<struct<at:int,size:int>>")), start, walk)["taken"], end)
    return split.select("run", F.element_at(F.transform(F.array(taken), spoken), 1).alias("words"))


def explode_words(df: DataFrame, text: str, dictionary: DataFrame | None = None, out: str = "keyword") -> DataFrame:
    """One row per word of ``text``; a text without words stays as one row with a null word."""
    exploded = explode_atoms(df, text, "_atom")
    return words_of_atoms(exploded, dictionary, "_atom", out)


def words_of_atoms(
    df: DataFrame, dictionary: DataFrame | None, atom: str = "atom", out: str = "keyword"
) -> DataFrame:
    """Replaces an atom column by words, with runs of ideographs split."""
    if dictionary is None:
        words = F.when(is_han(atom), F.split(F.col(atom), "")).otherwise(F.array(atom))
        return df.withColumn(out, F.explode(words)).drop(atom)
    # Letter runs are words as they are; only ideographs meet the dictionary.
    han = df.filter(is_han(atom))
    split = han_words(han, dictionary, atom).withColumnRenamed("run", atom)
    joined = skew.equi_join(han, split, [atom], "left", right_unique=True)
    plain = df.filter(~F.coalesce(is_han(atom), F.lit(False))).withColumn(out, F.col(atom)).drop(atom)
    return plain.unionByName(joined.withColumn(out, F.explode("words")).drop(atom, "words"))
