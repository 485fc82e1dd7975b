"""Sample labels harmonised: cleaned by rules, by known words, put into categories by keywords, else by likeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veinloom.functions import text as X
from veinloom.functions.label_words import RULES
from veinloom.operators import matching as M
from veinloom.operators import windows as W
from veinloom.pipelines.steps import Pipeline

LABELS = Pipeline("labels")

# Endings without which a word may be known.
SUFFIXES = ("s", "es", "ed", "ing", "ly", "er", "est")
#: A label that no rule takes gets the category of the most alike term, if the likeness reaches this.
CUTOFF = 0.75


def word_forms(word: Column) -> Column:
    """A word and what it is without each of the endings, if three letters are left."""
    return F.array_distinct(F.concat(F.array(word), F.filter(F.array(*[F.when(word.endswith(s) & (F.length(word) >= len(s) + 3), F.substring(word, F.lit(1), F.length(word) - len(s))) for s in SUFFIXES]), lambda w: w.isNotNull())))


@LABELS.step("occurrences", "counted")
def count_labels(t):
    """Labels in one spelling, with the number of their occurrences."""
    return {"counted": t["occurrences"].groupBy(F.trim("label").alias("label")).agg(F.count(F.lit(1)).alias("n"))}


@LABELS.step("counted", "meaningful")
def filter_by_rules(t):
    """Labels that the rules keep."""
    return {"meaningful": t["counted"].where(X.meaningful_label("label"))}


@LABELS.step("meaningful words", "known")
def filter_by_words(t):
    """Labels all of whose words, with or without an ending, are in the word list."""
    parts = t["meaningful"].select("label", F.explode(X.split_multi(F.lower(X.camel_split("label")))).alias("word")).distinct()
    forms = parts.select("label", "word", F.explode(word_forms(F.col("word"))).alias("form"))
    found = forms.join(t["words"].select(F.lower("word").alias("form")).distinct().withColumn("hit", F.lit(True)), "form", "left").groupBy("label", "word").agg(F.bool_or(F.coalesce("hit", F.lit(False))).alias("hit"))
    good = found.groupBy("label").agg(F.bool_and("hit").alias("all")).where("all").select("label")
    return {"known": t["meaningful"].join(good, "label", "left_semi")}


@LABELS.step("known", "categorized open")
def categorize_by_keywords(t):
    """Labels that a category's words take, with the confidence, and those left."""
    found = t["known"].withColumn("c", M.categorize(F.col("label"), RULES))
    return {"categorized": found.where("c is not null").select("label", "n", "c.category", "c.confidence"), "open": found.where("c is null").select("label", "n")}


def nearest_category(labels: DataFrame, cutoff: float) -> DataFrame:
    """label, n, category and confidence of labels that are alike to a term of a category; the terms are some dozens."""
    terms = [(name, term) for name, exact, keywords, _ in RULES for term in dict.fromkeys([*exact, *keywords])]
    every = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(x).alias("term")) for c, x in terms])
    pairs = labels.select("label", "n", F.explode(every).alias("t")).select("label", "n", "t.*")
    near = 2 * F.least(F.length("label"), F.length("term")) >= cutoff * (F.length("label") + F.length("term"))
    scored = pairs.where(near).withColumn("score", F.round(X.similarity(F.lower("label"), F.col("term")), 6)).where(F.col("score") >= cutoff)
    best = W.first_per_key(scored, ["label"], [F.col("score").desc(), F.col("category"), F.col("term")])
    return best.select("label", "n", "category", F.when(F.col("score") >= 0.9, "HIGH").otherwise("MEDIUM").alias("confidence"))


@LABELS.step("categorized open", "assigned")
def assign_by_likeness(t):
    """All labels with a category, by keyword or by likeness."""
    by_words = t["categorized"].withColumn("method", F.lit("keyword"))
    return {"assigned": by_words.unionByName(nearest_category(t["open"], CUTOFF).withColumn("method", F.lit("likeness")))}


@LABELS.step("assigned values", "properties")
def prepare_properties(t):
    """For each sample and category the different values of its labels, in order, joined."""
    rows = t["values"].withColumn("label", F.trim("label")).join(t["assigned"].select("label", "category"), "label")
    once = W.first_per_key(rows, ["sample", "category", "value"], [F.col("place")])
    listed = F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"])
    return {"properties": once.groupBy("sample", "category").agg(F.array_join(listed, " | ").alias("value"))}
