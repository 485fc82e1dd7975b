"""Repeated passages by hashing lines and the sentences in them: units are normalised, digests grouped globally, the
earliest occurrence stays, and what repeats it goes, with its offsets in the original text.

1. A text is cut into units at line and sentence ends. A short sentence joins the next one unless its own hash says
   otherwise; that depends on the sentence only, so a passage is cut alike wherever it stands.
2. Digests of all units are grouped; each later occurrence of a unit learns where the first one is. In a text, units that
   lie as far apart as their first occurrences do in theirs form a core.
3. Where a passage begins or ends inside a unit, its border words are compared with those around the first occurrence. So
   cores grow word by word; a core that then has enough words goes, and shorter repetitions (stock lines) stay.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinloom.llm.jaccard_join import beside, identified
from veinloom.llm.quality_classifier import in_chunks
from veinloom.llm.storage import Scratch, table, written
from veinloom.llm.worker_cache import forget

#: A repeated passage of fewer words stays.
MIN_WORDS = 50
#: A sentence of so many words ends a unit; of shorter ones, one in SHORT_ENDS does, by its hash.
UNIT_WORDS, SHORT_ENDS = 6, 4
#: Characters beside a core whose words are compared first; a core whose border is equal all along is compared again with
#: MORE times as many, up to the first difference or the end of the text.
CONTEXT_CHARS, MORE = 2_000, 8
_SENTENCE = regex.compile(r"[^\n.!?]*+(?:[.!?]++(?![ \n]|\Z)[^\n.!?]*+)*+(?:[.!?]++[ ]*+|\n|\Z)")
_WORD = regex.compile(r"\S+")
_WORD_BACKWARD = regex.compile(r"(?r)\S+")
#: Characters of scripts that write no blanks; two count as a word.
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")
_UNIT = "doc_id long, h long, seq int, start int, end int, n int, before int, behind int, d1 long, d2 long"


def units_of(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, words, normal form) of a text's units in order; they cover the text but for blank ends."""
    out = []
    unspaced = _UNSPACED.search(text) is not None
    parts: list[str] = []
    start = end = words = 0
    for m in _SENTENCE.finditer(text):
        sentence = m.group()
        own = sentence.lower().split()
        if not own:
            continue
        if not parts:
            start = m.start() + len(sentence) - len(sentence.lstrip())
        normal = " ".join(own)
        parts.append(normal)
        end = m.start() + len(sentence.rstrip())
        words += len(own) + (len(_UNSPACED.findall(sentence)) // 2 if unspaced else 0)
        if len(own) >= UNIT_WORDS or xxhash.xxh3_64_intdigest(normal.encode("utf-8", "surrogatepass")) % SHORT_ENDS == 0:
            out.append((start, end, words, " ".join(parts)))
            parts, words = [], 0
    if parts:
        out.append((start, end, words, " ".join(parts)))
    return out


def unit_rows(documents: DataFrame) -> DataFrame:
    """One row for each unit: its text (doc_id, h), place, span, words, where the unit before it begins and the one behind
    it ends, and its digest of 128 bits. Rows without an id have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            ids, hashes, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for a, b in in_chunks(texts, 1_000_000):
                rows: list[list] = [[] for _ in range(10)]
                for d, h, x in zip(ids[a:b], hashes[a:b], texts[a:b]):
                    units = units_of(x) if x else []
                    for i, (s, e, n, normal) in enumerate(units):
                        digest = xxhash.xxh3_128_intdigest(normal.encode("utf-8", "surrogatepass"))
                        row = (d, h, i, s, e, n, units[i - 1][0] if i else s, units[i + 1][1] if i + 1 < len(units) else e, (digest >> 64) - (1 << 63), (digest & ((1 << 64) - 1)) - (1 << 63))
                        for column, value in zip(rows, row):
                            column.append(value)
                types = [pa.int64()] * 2 + [pa.int32()] * 6 + [pa.int64()] * 2
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=["doc_id", "h", "seq", "start", "end", "n", "before", "behind", "d1", "d2"])

    return identified(documents).where("doc_id is not null").mapInArrow(run, _UNIT)


def cores_of(units: list[dict], min_words: int) -> list[dict]:
    """Cores of a text from its repeated units (seq, start, end, n, before, behind, and a: doc_id, h, seq, start, end of the
    first occurrence). A core's units are all repeated, and its ends keep the same distance from their first occurrences.
    Characters beside it that may belong to the passage are counted as left and right, as many as min_words may need."""
    units = sorted(units, key=lambda u: u["seq"])
    out = []
    begin = 0
    while begin < len(units):
        stop = begin + 1
        while stop < len(units) and units[stop]["seq"] == units[stop - 1]["seq"] + 1:
            stop += 1
        chain = units[begin:stop]
        begin = stop
        groups: dict[tuple, list[int]] = defaultdict(list)
        for i, u in enumerate(chain):
            groups[u["a"]["doc_id"], u["a"]["h"], u["seq"] - u["a"]["seq"]].append(i)
        for places in groups.values():
            i, j = places[0], places[-1]
            first, last = chain[i], chain[j]
            words = sum(u["n"] for u in chain[i : j + 1])
            k, room = i, 0
            while k > 0 and room < min_words:
                k -= 1
                room += chain[k]["n"]
            left = first["start"] - (chain[k]["start"] if room >= min_words else chain[k]["before"])
            k, room = j, 0
            while k < len(chain) - 1 and room < min_words:
                k += 1
                room += chain[k]["n"]
            right = (chain[k]["end"] if room >= min_words else chain[k]["behind"]) - last["end"]
            # Two characters make a word at least, a letter and a blank; in scripts without blanks, borders don't grow.
            if words + left // 2 + right // 2 + 2 >= min_words:
                out.append({"start": first["start"], "end": last["end"], "n": words, "left": left, "right": right, "a_doc": first["a"]["doc_id"], "a_h": first["a"]["h"], "a_start": first["a"]["start"], "a_end": last["a"]["end"]})
    return out


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_CORE = pa.struct([(k, pa.int64()) for k in ("start", "end", "n", "left", "right", "a_doc", "a_h", "a_start", "a_end")])


def _outward(words: Iterator, cut: bool) -> Iterator:
    """The words of a side from the core outwards, without the last one if the side was cut."""
    held = next(words, None)
    for m in words:
        yield held
        held = m
    if held is not None and not cut:
        yield held


def equal_words(mine: Iterator, theirs: Iterator, cut: bool, other_cut: bool) -> tuple[int, tuple | None, bool]:
    """How many words (matches) are equal from the first on, the last of them on both sides, and whether there may be more
    behind the end of what was fetched; the last word of a side that was cut may be part of one and does not count. Words
    behind the first difference are not looked at."""
    mine, theirs = _outward(mine, cut), _outward(theirs, other_cut)
    k, last = 0, None
    while True:
        x, y = next(mine, None), next(theirs, None)
        if x is None or y is None:
            return k, last, (x is not None or cut) and (y is not None or other_cut)
        if x.group().lower() != y.group().lower():
            return k, last, False
        k, last = k + 1, (x, y)


def grown(core: dict, left: str, right: str, a_left: str, a_right: str, block: int) -> dict:
    """The core after its borders have grown over equal words. left and right are up to `block` characters beside it,
    a_left and a_right up to block + 64 beside its first occurrence. With `more`, growing is to go on."""
    core = dict(core)
    k, last, more_left = equal_words(_WORD_BACKWARD.finditer(left), _WORD_BACKWARD.finditer(a_left), core["left"] > block, core["a_start"] > block + 64)
    if last:
        by = len(left) - last[0].start()
        core |= {"start": core["start"] - by, "left": core["left"] - by, "a_start": core["a_start"] - (len(a_left) - last[1].start())}
    j, last, more_right = equal_words(_WORD.finditer(right), _WORD.finditer(a_right), core["right"] > block, len(a_right) == block + 64)
    if last:
        by = last[0].end()
        core |= {"end": core["end"] + by, "right": core["right"] - by, "a_end": core["a_end"] + last[1].end()}
    core["left"], core["right"] = core["left"] if more_left else 0, core["right"] if more_right else 0
    return core | {"n": core["n"] + k + j, "more": more_left or more_right}


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def passages(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, h (hash of the text) and spans (start, end; code points, end exclusive, merged) of all texts with an id in
    which a passage of min_words or more repeats an earlier one.

    Earlier is by (doc_id, h, place), so the first occurrence of everything stays. Rows of equal id and text are one; rows
    of one id with different texts are told apart. Null and empty texts have no units. Not found are passages without a
    whole unit in them (one unbroken sentence), and those whose units are no later ones.
    """
    with Scratch(documents.sparkSession) as scratch:
        units = scratch.written(unit_rows(documents), "units")
        # Partial aggregation first: a unit of which a third of all rows are copies is one row a task.
        at = F.struct("doc_id", "h", "seq", "start", "end")
        # Written, so that the join below is one of two plain shuffles, of which Spark splits the hot side.
        first = scratch.written(units.groupBy("d1", "d2").agg(F.min(at).alias("a"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), "first")
        place = F.struct("doc_id", "h", "seq")
        later = units.join(first, ["d1", "d2"]).where(F.struct("a.doc_id", "a.h", "a.seq") != place)
        repeated = later.groupBy("doc_id", "h").agg(F.collect_set(F.struct("seq", "start", "end", "n", "before", "behind", "a")).alias("units"))  # bounded by a text

        def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forget()
            for batch in batches:
                found = [cores_of(u, min_words) for u in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(_CORE))], names=["doc_id", "h", "cores"])

        fields = ", ".join(f"{f.name}: long" for f in _CORE)
        found = scratch.written(repeated.mapInArrow(cores, f"doc_id long, h long, cores array<struct<{fields}>>").select("doc_id", "h", F.explode("cores").alias("c")).select("doc_id", "h", "c.*"), "cores")
        scratch.drop(units, first)
        spans = found.where("left = 0 and right = 0").select("doc_id", "h", "start", "end").unionByName(_grown_cores(documents, found.where("left > 0 or right > 0"), min_words, scratch))
        listed = spans.groupBy("doc_id", "h").agg(F.collect_set(F.struct("start", "end")).alias("spans"))  # bounded by a text

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forget()
            for batch in batches:
                out = [[{"start": s, "end": e} for s, e in merged([(x["start"], x["end"]) for x in r])] for r in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, _SPANS)], names=["doc_id", "h", "spans"])

        return written(listed.mapInArrow(join, "doc_id long, h long, spans array<struct<start: long, end: long>>"), "passages")


def _grown_cores(documents: DataFrame, cores: DataFrame, min_words: int, scratch: Scratch) -> DataFrame:
    """doc_id, h, start, end of the cores that reach min_words with their borders. Only pieces of text beside the cores
    and beside their first occurrences are shuffled, not texts; few cores need a second, longer piece."""
    done, block = None, CONTEXT_CHARS
    while True:
        step = scratch.written(_grown_once(documents, cores, block), "grown")
        ready = step.where(~F.col("more") & (F.col("n") >= min_words)).select("doc_id", "h", "start", "end")
        done = ready if done is None else done.unionByName(ready)
        cores = step.where("more").drop("more")
        if not cores.limit(1).count():
            return done
        block *= MORE


def _grown_once(documents: DataFrame, cores: DataFrame, block: int) -> DataFrame:
    own = cores.columns
    at = {"_d": "doc_id", "_h": "h", "_s": "start", "_e": "end"}
    mine = cores.select(*own, *[F.col(v).alias(k) for k, v in at.items()], F.least("left", F.lit(block)).alias("_l"), F.least("right", F.lit(block)).alias("_r"), F.lit(True).alias("mine"))
    # A little more of the other text, for white space that differs.
    theirs = cores.select(*own, *[F.col(v).alias(k) for k, v in {"_d": "a_doc", "_h": "a_h", "_s": "a_start", "_e": "a_end"}.items()], F.when(F.col("left") > 0, block + 64).otherwise(0).alias("_l"), F.when(F.col("right") > 0, block + 64).otherwise(0).alias("_r"), F.lit(False).alias("mine"))
    texts = identified(documents).toDF("_d", "_h", "_text")
    piece = mine.unionByName(theirs).join(texts, ["_d", "_h"])
    begin = F.greatest(F.col("_s") - F.col("_l"), F.lit(0))
    piece = piece.select(*own, "mine", F.substring("_text", (begin + 1).cast("int"), (F.col("_s") - begin).cast("int")).alias("l"), F.substring("_text", (F.col("_e") + 1).cast("int"), F.col("_r").cast("int")).alias("r"))
    side = lambda c, mine: F.max(F.when(F.col("mine") == mine, F.col(c))).alias(f"{c}_{mine}")
    pairs = piece.groupBy(*own).agg(side("l", True), side("r", True), side("l", False), side("r", False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            rows = batch.to_pylist()
            out = [grown({c: x[c] for c in own}, x["l_True"] or "", x["r_True"] or "", x["l_False"] or "", x["r_False"] or "", block) for x in rows]
            yield pa.RecordBatch.from_arrays([*[pa.array([x[c] for x in out], pa.int64()) for c in own], pa.array([x["more"] for x in out], pa.bool_())], names=[*own, "more"])

    return pairs.mapInArrow(run, ", ".join([*[f"`{c}` long" for c in own], "more boolean"]))


def removals(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_chars and spans to remove of every row; see passages. Rows without an id keep all. Other columns are not
    read; an empty table gives no rows."""
    every = identified(documents).select("doc_id", "h", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"))
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return every.join(passages(documents, min_words), ["doc_id", "h"], "left").select("doc_id", "n_chars", F.coalesce("spans", none).alias("spans"))


def dedup_passages(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of documents, `text` without the repeated passages."""
    joined = beside(documents, passages(documents, min_words), "spans")
    at, last = documents.columns.index("text"), len(documents.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            new = [without(x, [(s["start"], s["end"]) for s in r]) if r else x for x, r in zip(batch.column(at).to_pylist(), batch.column(last).to_pylist())]
            columns = [batch.column(i) for i in range(last)]
            columns[at] = pa.array(new, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:last])

    return joined.mapInArrow(run, documents.schema)


def without(text: str, spans: list[tuple[int, int]]) -> str:
    out, at = [], 0
    for s, e in spans:
        out.append(text[at:s])
        at = e
    return "".join(out) + text[at:]


def op5_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of documents: the spans that repeat an earlier passage, and their number and size."""
    found = removals(table(spark, sf_dir, "documents"))
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    cut = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select("doc_id", "n_chars", F.size("spans").cast("long").alias("n_spans"), cut.alias("n_removed_chars"), listed.alias("spans"))


QUERIES: dict[str, Callable] = {"op5_unit_dedup": op5_unit_dedup}
ORACLES: dict[str, str] = {}
