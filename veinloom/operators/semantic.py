"""How much a text is about a definition: the cosine of their word vectors, fitted to a corpus.

A vector has a word's count times its inverse document frequency. Vectors stay sparse, as rows of words, so a cosine is a
join on words; nothing is downloaded, and nothing but the number of texts comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veinloom.functions import text as X


def inverse_frequencies(corpus: DataFrame, text: str) -> tuple[DataFrame, float]:
    """word and idf = ln((1 + N) / (1 + n)) + 1 for the n of N texts that have it; and the idf of a word that none has."""
    n_texts = F.lit(corpus.count())
    words = corpus.select(F.explode(F.array_distinct(X.tokens(F.lower(F.col(text))))).alias("word"))
    found = words.groupBy("word").agg((F.log((1.0 + n_texts) / (1.0 + F.count(F.lit(1)))) + 1.0).alias("idf"))
    return found, F.log(1.0 + n_texts) + 1.0


def word_vectors(texts: DataFrame, key: str, text: str, idf: tuple[DataFrame, float]) -> DataFrame:
    """key, word, weight of each different word, and norm, the length of the text's vector, in each row."""
    known, unknown = idf
    counts = texts.select(key, F.explode(X.tokens(F.lower(F.col(text)))).alias("word")).groupBy(key, "word").agg(F.count(F.lit(1)).alias("_n"))
    return counts.join(known, "word", "left").select(key, "word", (F.col("_n") * F.coalesce("idf", unknown)).alias("weight"))


def similarity(pairs: DataFrame, key: str, texts: DataFrame, text: str, name: str, definitions: DataFrame, definition: str, idf: tuple[DataFrame, float], score: str = "about") -> DataFrame:
    """pairs (key, name and what else they have) with the cosine of the key's text and the name's definition: 0 where they
    share no word, null where one of them has no words or is missing. keys of texts and names of definitions are unique."""
    wanted = texts.join(pairs.select(key).distinct(), key, "left_semi")
    a = word_vectors(wanted, key, text, idf)
    b = word_vectors(definitions.join(pairs.select(name).distinct(), name, "left_semi"), name, definition, idf).withColumnRenamed("weight", "_other")
    lengths = [rows.groupBy(k).agg(F.sqrt(F.sum(F.col(w) * F.col(w))).alias(to)) for rows, k, w, to in ((a, key, "weight", "_la"), (b, name, "_other", "_lb"))]
    products = pairs.select(key, name).distinct().join(b, name).join(a, [key, "word"]).groupBy(key, name).agg(F.sum(F.col("weight") * F.col("_other")).alias("_dot"))
    joined = pairs.join(products, [key, name], "left").join(lengths[0], key, "left").join(lengths[1], name, "left")
    cosine = F.when(F.col("_la").isNotNull() & F.col("_lb").isNotNull(), F.coalesce("_dot", F.lit(0.0)) / (F.col("_la") * F.col("_lb")))
    return joined.select(*pairs.columns, cosine.alias(score))
