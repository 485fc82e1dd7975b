"""A token tagger: an averaged perceptron over hashed features with Viterbi decoding, taught by projected labels.

Labels come from a gazetteer: where one of its names stands in a text, its tokens get the name's kind. The tagger learns
from the tokens' forms and neighbours, so it also finds names that no gazetteer has. Training goes over all texts where they
lie: each round every partition starts from the same weights, and the partitions' averaged weights are mixed by the numbers
of their sentences, by a grouped sum.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veinloom.operators.inference import inferred, shared
from veinloom.operators.lineage import checkpointed

#: Hashed features; with seven tags the weights take 15 MB at most, whatever the texts.
SIZE = 1 << 18
ROUNDS = 4
#: Words between neighbours whose features a task keeps, and tokens that are tagged at a time.
WINDOWS_KNOWN, TOKENS = 1 << 16, 1 << 14
#: Characters of a partition in training, about, and partitions at most.
PARTITION_CHARS, MOST_PARTITIONS = 400_000, 2_000
#: A gazetteer of more characters is refused, as it is broadcast.
GAZETTEER_CHARS = 8_000_000
_TOKEN = re.compile(r"\w+|[^\w\s]")
_SENTENCE = re.compile(r"(?<=[.?!])\s+(?=[^\W\d_a-zà-ÿ])|\n+")


def tokens_of(text: str) -> list[list[tuple[int, int]]]:
    """Spans of the tokens of each sentence."""
    out, start = [], 0
    for end in [*[m.end() for m in _SENTENCE.finditer(text)], len(text)]:
        if found := [m.span() for m in _TOKEN.finditer(text, start, end)]:
            out.append(found)
        start = end
    return out


def _shape(w: str) -> str:
    return re.sub(r"(.)\1+", r"\1", "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in w))


def _hashed(before: str, last: str, word: str, following: str) -> tuple[int, ...]:
    """Hashed features of a word: itself, its ends and shape, and its neighbours and their shapes ("" where there is none)."""
    w, low, after, far = word.lower(), last.lower() or "^", following.lower() or "$", before.lower() or "^"
    own, left, right = _shape(word), _shape(last) or "^", _shape(following) or "$"
    named = ("b", "w" + w, "s" + w[-3:], "p" + w[:2], "h" + own, "l" + low, "r" + after, "L" + left + own, "R" + own + right, "k" + low + " " + own, "q" + far)
    return tuple(zlib.crc32(x.encode()) % SIZE for x in named)


class Features:
    """Rows of hashed features; each different word between the same neighbours is hashed once, of so many that are kept."""

    def __init__(self):
        self.at: dict[tuple[str, str, str, str], int] = {}
        self.rows = np.zeros((1024, 11), dtype=np.int32)

    def of(self, sentences: list[list[str]]) -> np.ndarray:
        """A row for each word of the sentences."""
        if len(self.at) > WINDOWS_KNOWN:
            self.at = {}
        at, out = self.at, []
        for words in sentences:
            for window in zip(["", "", *words], ["", *words], words, [*words[1:], ""]):
                i = at.get(window)
                if i is None:
                    at[window] = i = len(at)
                    if i == len(self.rows):
                        self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                    self.rows[i] = _hashed(*window)
                out.append(i)
        return self.rows[np.array(out, dtype=np.int64)].astype(np.int64)


#: What this worker has hashed, from task to task.
_KNOWN = Features()


def features(words: list[str]) -> np.ndarray:
    """A row of hashed features for each word of a sentence."""
    return _KNOWN.of([words])


class Tagger:
    """Tags are 0 (outside) and for each kind one for a name's first token and one for its others."""

    def __init__(self, kinds: Sequence[str], weights: np.ndarray | None = None):
        self.kinds = list(kinds)
        self.tags = 1 + 2 * len(self.kinds)
        #: A row for each tag: a weight for each feature, and for each tag before it, the last for none.
        self.weights = np.zeros((self.tags, SIZE + self.tags + 1), dtype=np.float64) if weights is None else weights
        #: An inner tag follows the first or an inner tag of its kind only.
        self.barred = np.zeros((self.tags + 1, self.tags), dtype=bool)
        for k in range(len(self.kinds)):
            self.barred[:, 2 + 2 * k] = True
            self.barred[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = False

    def scores(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each token and tag, and of each tag after another or after none."""
        between = self.weights[:, SIZE:].T.copy()
        between[self.barred] = -np.inf
        return self.weights[:, found].sum(axis=2).T, between

    def decode(self, found: np.ndarray) -> list[int]:
        """The best tags of a sentence."""
        return self.decode_all(found, [len(found)]).tolist()

    def decode_all(self, found: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
        """The best tags of sentences of these sizes one after the other, by Viterbi: all sentences go a token further at once."""
        sizes = np.asarray(sizes, dtype=np.int64)
        begin, out = np.cumsum(sizes) - sizes, np.zeros(len(found), dtype=np.int64)
        order = np.argsort(-sizes, kind="stable")
        order = order[sizes[order] > 0]
        while len(order):
            n = max(1, TOKENS // int(sizes[order[0]]))  # the longest first, so those that go on are always the first ones
            some, order = order[:n], order[n:]
            start, size = begin[some], sizes[some]
            longest = int(size[0])
            own, between = self.scores(found[np.concatenate([np.arange(a, a + m) for a, m in zip(start.tolist(), size.tolist())])])
            at = np.cumsum(size) - size
            going = np.searchsorted(-size, -np.arange(longest), side="left").tolist()  # how many have a token at each place
            best, back = own[at] + between[-1], np.zeros((longest, len(some), self.tags), dtype=np.int64)
            for t in range(1, longest):
                k = going[t]
                way = best[:k, :, None] + between[None, :-1]
                back[t, :k] = to = way.argmax(axis=1)
                best[:k] = np.take_along_axis(way, to[:, None], axis=1)[:, 0] + own[at[:k] + t]
            tag = best.argmax(axis=1)
            for t in range(longest - 1, -1, -1):
                k = going[t]
                out[start[:k] + t] = tag[:k]
                if t:
                    tag[:k] = back[t, np.arange(k), tag[:k]]
        return out

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """Start, end and kind of each name in a whole text."""
        return self.spans_all([text])[0]

    def spans_all(self, texts: Sequence[str]) -> list[list[tuple[int, int, str]]]:
        """The same for each of several texts."""
        out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
        for block in in_blocks((i, text, places) for i, text in enumerate(texts) for places in tokens_of(text)):
            tags = iter(self.decode_all(_KNOWN.of([[text[a:b] for a, b in places] for _, text, places in block]), [len(places) for _, _, places in block]).tolist())
            for i, _, places in block:
                own = out[i]
                for (a, b), tag in zip(places, tags):
                    if tag and tag % 2 == 0:
                        own[-1] = (own[-1][0], b, own[-1][2])
                    elif tag:
                        own.append((a, b, self.kinds[(tag - 1) // 2]))
        return out


def in_blocks(sentences: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Sentences (their places last) in blocks of TOKENS tokens; a longer sentence is a block by itself."""
    block, n = [], 0
    for x in sentences:
        if block and n + len(x[-1]) > TOKENS:
            yield block
            block, n = [], 0
        block.append(x)
        n += len(x[-1])
    if block:
        yield block


def projected(places: list[tuple[int, int]], text: str, names: dict[tuple[str, ...], int], longest: dict[str, int]) -> list[int]:
    """Tags of a sentence's tokens from the gazetteer: at each token its longest name that starts there, left to right.
    longest: tokens of the longest name that starts with a word."""
    words = [text[a:b].lower() for a, b in places]
    tags, i = [0] * len(words), 0
    while i < len(words):
        for n in range(min(longest.get(words[i], 0), len(words) - i), 0, -1):
            kind = names.get(tuple(words[i : i + n]))
            if kind is not None:
                tags[i : i + n] = [1 + 2 * kind] + [2 + 2 * kind] * (n - 1)
                i += n
                break
        else:
            i += 1
    return tags


class _Lesson:
    """One partition's pass: weights, and their sums over all steps for the average."""

    def __init__(self, tagger: Tagger):
        self.tagger, self.late, self.step, self.pace = tagger, np.zeros_like(tagger.weights), 1, 2

    def _add(self, tag: int, places, by: float) -> None:
        np.add.at(self.tagger.weights[tag], places, by)
        np.add.at(self.late[tag], places, by * self.step)

    def learn(self, found: np.ndarray, sizes: Sequence[int], gold: np.ndarray) -> None:
        """Sentences one after the other. Several are tagged at once; up to the first wrong one the weights are what each
        would have met, and those after it are tagged again, fewer at a time where many are wrong."""
        ends = np.cumsum(sizes)
        begin, i = ends - sizes, 0
        while i < len(sizes):
            j = min(len(sizes), i + self.pace)
            got = self.tagger.decode_all(found[begin[i] : ends[j - 1]], sizes[i:j])
            wrong = np.flatnonzero(got != gold[begin[i] : ends[j - 1]])
            if not len(wrong):
                self.step += j - i
                i, self.pace = j, min(2 * self.pace, 1024)
                continue
            m = int(np.searchsorted(ends, begin[i] + wrong[0], side="right"))
            self.step += m - i
            own = slice(begin[m], ends[m])
            self._correct(found[own], gold[own].tolist(), got[begin[m] - begin[i] : ends[m] - begin[i]].tolist())
            self.step += 1
            i, self.pace = m + 1, max(2, self.pace // 2)

    def _correct(self, found: np.ndarray, gold: list[int], got: list[int]) -> None:
        for i, (g, w) in enumerate(zip(gold, got)):
            if g != w:
                self._add(g, found[i], 1.0)
                self._add(w, found[i], -1.0)
            before = (gold[i - 1], got[i - 1]) if i else (self.tagger.tags, self.tagger.tags)
            if (before[0], g) != (before[1], w):
                self._add(g, [SIZE + before[0]], 1.0)
                self._add(w, [SIZE + before[1]], -1.0)

    def averaged(self) -> np.ndarray:
        return self.tagger.weights - self.late / self.step


def _pass(batches: Iterator[pa.RecordBatch], start, gazetteer, kinds: list[str]) -> Iterator[pa.RecordBatch]:
    names = gazetteer.value
    longest: dict[str, int] = {}
    for name in names:
        longest[name[0]] = max(longest.get(name[0], 0), len(name))
    lesson = _Lesson(Tagger(kinds, start.value.copy()))
    n = 0
    for batch in batches:
        for block in in_blocks((text, places) for text in batch.column(0).to_pylist() for places in tokens_of(text or "")):
            found = _KNOWN.of([[text[a:b] for a, b in places] for text, places in block])
            gold = [projected(places, text, names, longest) for text, places in block]
            lesson.learn(found, np.array([len(g) for g in gold]), np.concatenate(gold))
            n += len(gold)
    if n:
        flat = lesson.averaged().ravel()
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(flat[at] * n, float(n)))], names=["at", "weight"])


def trained(texts: DataFrame, text: str, gazetteer: DataFrame, rounds: int = ROUNDS) -> Tagger:
    """A tagger for the kinds of a gazetteer (kind, name), taught by all texts. Null texts teach nothing; of a name with
    several kinds the least counts; no names or texts give a tagger that finds nothing."""
    spark = texts.sparkSession
    named = gazetteer.where("kind is not null and name is not null").groupBy(F.lower("name").alias("name")).agg(F.min("kind").alias("kind"))
    if (named.agg(F.sum(F.length("name"))).first()[0] or 0) > GAZETTEER_CHARS:
        raise ValueError(f"a gazetteer of more than {GAZETTEER_CHARS} characters")
    rows = named.collect()
    kinds = sorted({r["kind"] for r in rows})
    words = {tuple(_TOKEN.findall(r["name"])): kinds.index(r["kind"]) for r in rows}
    words.pop((), None)
    sent = spark.sparkContext.broadcast(words)
    tagger = Tagger(kinds)
    said = texts.select(F.col(text).alias("_text"))
    if words:  # laid out once for all rounds, in as many partitions as there is text for
        chars = said.agg(F.sum(F.length("_text"))).first()[0] or 0
        said = checkpointed(said.repartition(min(MOST_PARTITIONS, 1 + chars // PARTITION_CHARS)))
    for _ in range(rounds if words else 0):
        start = spark.sparkContext.broadcast(tagger.weights)
        learnt = said.mapInArrow(partial(_pass, start=start, gazetteer=sent, kinds=kinds), "at long, weight double")
        mixed = learnt.groupBy("at").agg(F.sum("weight").alias("weight")).toArrow()  # bounded by the number of weights
        start.destroy()
        at, weight = (mixed.column(i).to_numpy() for i in (0, 1))
        total = weight[at == -1]
        if not len(total):
            break
        weights = np.zeros(tagger.weights.size)
        weights[at[at >= 0]] = weight[at >= 0] / total[0]
        tagger = Tagger(kinds, weights.reshape(tagger.weights.shape))
    sent.destroy()
    return tagger


def _load(model, say):
    def load():
        tagger = model()
        return lambda texts: [say(x, spans) for x, spans in zip(texts, tagger.spans_all(texts))]

    return load


def _masked(tagger: Tagger, text: str) -> str:
    return _with_kinds(text, tagger.spans(text))


def _as_json(text: str, spans: list[tuple[int, int, str]]) -> str:
    return json.dumps([{"start": a, "end": b, "kind": k, "name": text[a:b]} for a, b, k in spans])


def _with_kinds(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for a, b, kind in spans:
        out += [text[at:a], f"[{kind}]"]
        at = b
    return "".join(out) + text[at:]


def _spread(texts: DataFrame) -> DataFrame:
    """Dealt to all cores: what joins give may be few partitions, as it is small in bytes beside the time that it takes."""
    spark = texts.sparkSession
    return texts.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def mask_names(texts: DataFrame, text: str, tagger: Tagger, name: str = "masked") -> DataFrame:
    """texts with a column of the text in which each name is its kind in brackets. Nulls stay null, empty texts empty."""
    return _spread(texts).withColumn(name, inferred(F.col(text), _load(shared(texts.sparkSession, tagger), _with_kinds), T.StringType()))


def named_spans(texts: DataFrame, key: str, text: str, tagger: Tagger) -> DataFrame:
    """key, start, end, kind and name of every name that the tagger finds."""
    said = _spread(texts).select(key, inferred(F.col(text), _load(shared(texts.sparkSession, tagger), _as_json), T.StringType()).alias("_said"))
    listed = F.from_json("_said", "array<struct<start: int, end: int, kind: string, name: string>>")
    return said.select(key, F.explode(listed).alias("_s")).select(key, "_s.start", "_s.end", "_s.kind", "_s.name")
