"""Search and suggestions that read only what a query can match (Q-3 to Q-8, A17, O5): postings by gram, and the best suggestions of each short query.

Both are tables of deltas (korbwerk/streaming/deltas.py) in buckets by their key, so a query reads the buckets of its own keys, by partition pruning, and skips row groups of other keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from korbwerk.operators import search
from korbwerk.streaming.deltas import BUCKETS, Deltas

#: Longest query whose suggestions are kept.
LONGEST = 6
#: What a value that doesn't hold the query can score: its count, and as a subsequence of two characters or more. Up to that, kept suggestions may lack one.
COUNT, SUBSEQUENCE = 20, 70


def parts_of(text: Column, size: int) -> Column:
    """Distinct parts of `size` characters."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(size))))


class SearchIndex:
    """Words of searchable rows by their grams: all parts of three characters, and the first one and two, marked by ^.

    A token has no blank, so wherever a field holds it, one word does. A posting has the word, its row and field (-1 for the description), the number and place of its first occurrence there, and whether it is the whole field;
    that is all that a field's score depends on. Rows are added by batches.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.key = spark, key
        self.postings, self.rows = Deltas(spark, f"{path}/postings", "gram", buckets), Deltas(spark, f"{path}/rows", key, buckets)

    def add(self, batch: int, rows: DataFrame) -> None:
        """rows: from search.searchable(), with distinct keys."""
        texts = F.concat(F.transform("_fields", lambda f, i: F.struct(i.alias("field"), f.alias("text"))), F.array(F.struct(F.lit(-1).alias("field"), F.col("_text").alias("text"))))
        fields = rows.select(self.key, F.explode(texts).alias("f")).select(self.key, "f.*").where("text <> ''")
        words = fields.select(self.key, "field", "text", F.posexplode(F.split("text", " ")).alias("number", "word"))
        # the first word that holds a token is the first occurrence of some word
        place = F.length(F.array_join(F.slice(F.split("text", " "), F.lit(1), F.col("number")), " ")) + F.when(F.col("number") > 0, 1).otherwise(0)
        found = words.select(self.key, "field", "word", "number", place.alias("place"), (F.col("text") == F.col("word")).alias("whole"))
        found = found.where("word <> ''").groupBy(self.key, "field", "word").agg(F.min("number").alias("number"), F.min("place").alias("place"), F.max("whole").alias("whole"))
        first = F.array_distinct(F.transform(F.array(F.lit(1), F.lit(2)), lambda n: F.concat(F.lit("^"), F.substring(F.col("word"), F.lit(1), n))))
        grams = F.when(F.col("field") >= 0, F.concat(first, parts_of(F.col("word"), 3))).otherwise(parts_of(F.col("word"), 3))
        self.postings.append(batch, found.withColumn("gram", F.explode(grams)))
        self.rows.append(batch, rows.select(self.key))

    def candidates(self, token: str) -> DataFrame:
        """Postings of words that hold the token (or begin with it, if it has one or two characters)."""
        gram = token[:3] if len(token) > 2 else f"^{token}"
        bucket = self.spark.range(1).select(F.pmod(F.xxhash64(F.lit(gram)), F.lit(self.postings.buckets)).cast("int")).first()[0]
        return self.postings.read(buckets=[bucket]).where((F.col("gram") == gram) & F.contains("word", F.lit(token)))

    def search(self, query: str) -> DataFrame:
        """Q-3 to Q-6: keys of the rows that match, with the score that search.search gives; all rows with 0 for an empty query."""
        tokens = [t for t in self.spark.range(1).select(search.normalise(F.lit(query))).first()[0].split(" ") if t]
        if not tokens:
            return self.rows.read().select(self.key, F.lit(0).alias("score"))
        scored = None
        for number, token in enumerate(tokens):
            own = self.candidates(token)
            begins = F.when(F.col("word").startswith(token), F.struct("number", (F.col("word") != token).alias("longer")))
            place = F.col("place") + F.call_function("locate", F.lit(token), F.col("word")) - 1
            fields = own.groupBy(self.key, "field").agg(F.max(F.col("whole") & (F.col("word") == token)).alias("whole"), F.min(begins).alias("first"), F.min(place).alias("place"))
            score = F.when(F.col("field") < 0, F.lit(28 if len(token) >= 4 else 0)).when(F.col("whole"), 110).when(~F.col("first.longer"), 95).when(F.col("first").isNotNull(), 80).otherwise(F.lit(100) - F.least("place", F.lit(40)) if len(token) > 2 else F.lit(0))
            in_fields = F.max(F.when(F.col("field") >= 0, F.col("s")))
            best = fields.withColumn("s", score).groupBy(self.key).agg(F.coalesce(in_fields, F.max("s")).alias("s")).where("s > 0").withColumn("token", F.lit(number))
            scored = best if scored is None else scored.unionByName(best)
        return scored.groupBy(self.key).agg(F.count("*").alias("n"), F.sum("s").cast("int").alias("score")).where(F.col("n") == len(tokens)).drop("n")

    def match_count(self, query: str) -> DataFrame:
        """Q-7."""
        return self.search(query).agg(F.count("*").alias("n"))


class SuggestionIndex:
    """The best suggestions of every query of up to LONGEST characters that some value holds, and all values for other queries.

    A value is scored for each of its parts as if that were the query, and of each part and kind the best stay; the window has a limit before its shuffle, so what moves is bounded by the parts, not by their values.
    """

    def __init__(self, spark: SparkSession, path: str, per_kind: int = 5, buckets: int = BUCKETS):
        self.spark, self.per_kind = spark, per_kind
        self.best, self.all, self.kinds = Deltas(spark, f"{path}/best", "part", buckets), Deltas(spark, f"{path}/all", "norm", buckets), Deltas(spark, f"{path}/kinds", "type", 1)

    def build(self, suggestions: DataFrame) -> None:
        """suggestions: from search.suggestions()."""
        parts = F.array_distinct(F.concat(*(parts_of(F.col("norm"), n) for n in range(1, LONGEST + 1))))
        rows = suggestions.withColumn("part", F.explode(parts)).where("part = trim(part)")
        length, inside = F.length("norm"), search.place_of(F.col("norm"), F.col("part"))
        score = F.when(F.col("norm") == F.col("part"), 200).when(inside == 0, F.lit(150) - F.least(length - F.length("part"), F.lit(30))).otherwise(F.lit(120) - inside) + F.least(F.col("n"), F.lit(20)).cast("int")
        scored = rows.withColumn("score", score).where("score > 0")
        order = Window.partitionBy("part", "type").orderBy(F.desc("score"), F.desc("n"), "value")
        self.best.append(0, scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= self.per_kind))
        self.all.append(0, suggestions)
        self.kinds.append(0, suggestions.select("type").distinct())

    def kept(self, query: str) -> DataFrame | None:
        """The kept suggestions of a query (normalised), or null where something may lack."""
        if not 0 < len(query) <= LONGEST:
            return None
        bucket = self.spark.range(1).select(F.pmod(F.xxhash64(F.lit(query)), F.lit(self.best.buckets)).cast("int")).first()[0]
        found = self.best.read(buckets=[bucket]).where(F.col("part") == query).drop("v", "part")
        # a kind is complete if its last place beats all that don't hold the query
        others = SUBSEQUENCE if len(query) > 1 else COUNT
        sure = found.groupBy("type").agg(F.count("*").alias("n"), F.min("score").alias("s")).where((F.col("n") >= self.per_kind) & (F.col("s") > others))
        return found if self.kinds.read().join(sure, "type", "left_anti").isEmpty() else None

    def suggest(self, query: str, most: int = 18) -> DataFrame:
        """O5, Q-8: what search.suggest gives."""
        q = self.spark.range(1).select(search.normalise(F.lit(query))).first()[0]
        found = self.kept(q)
        if found is None:
            return search.suggest(self.all.read().drop("v"), query, self.per_kind, most)
        return found.orderBy("type", "rank").limit(most)
