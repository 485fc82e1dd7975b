"""Byte-pair encoding by speculation: greedy longest match proposes, pair checks verify, only failing words are merged.

The vocabulary file (its path is a parameter) is one of the tokenizers library, of the kind with word ends: its
normaliser and pre-tokeniser are used as they are, on each different piece of text once; the merging is ours.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veinloom.llm.quality_classifier import in_chunks
from veinloom.llm.storage import table
from veinloom.llm.worker_cache import kept

#: Pieces that a worker remembers; the store is emptied when it is full, so memory is bounded.
MAX_PIECES = 800_000
MAX_WORDS = 600_000
#: Words of up to so many symbols are merged without a queue.
SHORT = 40
_NEVER = 1 << 60
_END = "￿"  # stands for the word end, as one character that no token holds


#: The byte alphabet: printable bytes stand for themselves, the others for the characters from U+0100 on, in order.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in _PLAIN)}


def _own_pattern(spec: dict):
    """The file's pre-tokeniser as a pattern, if its normaliser and pre-tokeniser are of the one shape known here."""
    steps = [x["type"] for x in ((spec["normalizer"] or {}).get("normalizers") or [])]
    cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers") or []
    if steps != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in cuts] != ["Split", "ByteLevel"]:
        return None
    if spec["normalizer"]["normalizers"][1]["pattern"] != {"Regex": "\\s+"} or cuts[0]["behavior"] != "Removed" or not cuts[0]["invert"] or cuts[1]["add_prefix_space"] or cuts[1]["use_regex"]:
        return None
    return regex.compile(cuts[0]["pattern"]["Regex"])


class SpeculativeBpe:
    """Encoder and decoder for one vocabulary file.

    Tokens are numbered anew by rank: first those that no merge makes, then the merges in their order. A proposal is
    right if and only if each two adjacent tokens of it would also come out of their joined text, which is found by
    undoing merges on both sides of the border from the latest to the earliest, for all pairs of a batch at once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        inner = lambda t: t[: -len(self.suffix)] + _END if self.suffix and t.endswith(self.suffix) else t
        vocab = {inner(t): i for t, i in model["vocab"].items()}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        made: dict[str, int] = {}
        again: set[str] = set()
        for k, (a, b) in enumerate(merges):
            whole = inner(a) + inner(b)
            again.update([whole] if whole in made else [])
            made.setdefault(whole, k)
        base = [t for t in vocab if t not in made]
        self.rank = {t: i for i, t in enumerate(base)} | {t: len(base) + k for t, k in made.items()}
        n = len(base) + len(merges)
        self.text = [""] * n
        self.id_of = np.full(n, -1, dtype=np.int64)
        for t, r in self.rank.items():
            self.text[r] = t
            self.id_of[r] = vocab[t]
        self.left, self.right = np.arange(n), np.arange(n)
        self.pair_made: dict[tuple[int, int], tuple[int, int]] = {}
        for k, (a, b) in enumerate(merges):
            a, b = inner(a), inner(b)
            made_rank = self.rank[a + b]
            if a in self.rank and b in self.rank:
                self.pair_made.setdefault((self.rank[a], self.rank[b]), (k, made_rank))
                if made[a + b] == k:
                    self.left[made_rank], self.right[made_rank] = self.rank[a], self.rank[b]
        keys = np.array([(a << 32) | b for a, b in self.pair_made], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_rank = np.array([k + len(base) for k, _ in self.pair_made.values()], dtype=np.int64)[order]
        #: By the first three characters, the length of the longest token that begins so.
        self.longest: dict[str, int] = {}
        for t in self.rank:
            self.longest[t[:3]] = max(len(t), self.longest.get(t[:3], 2))
        #: Tokens that their own text does not come out as, or that two merges make: never trusted.
        self.unsure = np.zeros(n, dtype=bool)
        self.unsure[[self.rank[t] for t in again]] = True
        for r in range(n):
            if self.text[r] and self.merge(self.text[r]) != [r]:
                self.unsure[r] = True
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.token_of = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.pattern = _own_pattern(spec)
        self.by_line = self.pattern and regex.compile(r"\n|" + self.pattern.pattern)
        #: Of each token by rank: its id in decimal, and how it is decoded.
        self.shown = [(str(i), self.token_of.get(i)) for i in self.id_of.tolist()]
        self.sizes = np.array([len(t) for t in self.text], dtype=np.int64)
        self.automaton = ahocorasick.Automaton()
        for t, r in self.rank.items():
            self.automaton.add_word(t, r)
        self.automaton.make_automaton()
        self.pieces: dict[str, tuple[int, str, str]] = {}
        self.words: dict[str, tuple[int, str, str]] = {}

    def propose(self, word: str) -> list[int]:
        """Greedy longest match; empty if some character is in no token."""
        out, i, n, rank, longest = [], 0, len(word), self.rank, self.longest
        whole = rank.get(word)
        if whole is not None:
            return [whole]
        last = n - 1 if word[-1:] == _END else n + 1  # a token that takes the last character takes the word end with it
        while i < n:
            for j in range(min(n, i + longest.get(word[i : i + 3], 2)), i, -1):
                r = rank.get(word[i:j])
                if r is not None and j != last:
                    out.append(r)
                    i = j
                    break
            else:
                return []
        return out

    def propose_all(self, words: list[str]) -> list[list[int]]:
        """propose() of each word (with its end): one pass of an automaton over all of them, and where that leaves
        characters over, propose() itself."""
        lengths = np.array([len(w) + 1 for w in words], dtype=np.int64)
        ends = np.cumsum(lengths)
        found = list(self.automaton.iter_long("".join([w + "\n" for w in words])))
        at = np.array([e for e, _ in found], dtype=np.int64)
        ranks = [r for _, r in found]
        sizes = self.sizes[ranks] if ranks else np.zeros(0, dtype=np.int64)
        owner = np.searchsorted(ends, at, side="right")
        covered = np.bincount(owner, weights=sizes, minlength=len(words)).astype(np.int64)
        counts = np.cumsum(np.bincount(owner, minlength=len(words))).tolist()
        whole = (covered == lengths - 1).tolist()
        return [ranks[a:b] if w else self.propose(word) for word, w, a, b in zip(words, whole, [0, *counts], counts)]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of adjacent tokens whether merging would keep the border between them."""
        a, b = a.copy(), b.copy()
        good = ~(self.unsure[a] | self.unsure[b])
        open_ = np.flatnonzero(good)
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(open_):
            x, y = a[open_], b[open_]
            key = (x << 32) | y
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            bad = (self.pair_keys[at] == key) & (self.pair_rank[at] < limit[open_])
            good[open_[bad]] = False
            open_ = open_[~bad]
            x, y = a[open_], b[open_]
            split_x, split_y = self.right[x] != x, self.left[y] != y
            # The later merge is undone first. What is made across the border must come before it: on the left side
            # strictly, on the right side a merge of the same rank further left would have gone first.
            take_x = split_x & (~split_y | (x > y))
            take_y = split_y & ~take_x
            limit[open_] = np.where(take_x, x, np.where(take_y, y + 1, limit[open_]))
            a[open_] = np.where(take_x, self.right[x], x)
            b[open_] = np.where(take_y, self.left[y], y)
            open_ = open_[take_x | take_y]
        return good

    def merge(self, word: str) -> list[int]:
        """Exact merging: always the earliest merge, of those the leftmost; n log n."""
        symbols = list(word)
        if len(symbols) > 1 and symbols[-1] == _END:
            symbols[-2:] = [symbols[-2] + _END]
        part = [self.rank[s] for s in symbols if s in self.rank]
        n = len(part)
        if n <= SHORT:
            return self._merge_short(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        queue = []
        for i in range(n - 1):
            if m := self.pair_made.get((part[i], part[i + 1])):
                queue.append((m[0], i, part[i], part[i + 1], m[1]))
        heapq.heapify(queue)
        while queue:
            _, i, x, y, whole = heapq.heappop(queue)
            j = after[i] if alive[i] else n
            if j >= n or part[i] != x or part[j] != y:
                continue
            part[i], alive[j] = whole, False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                if m := self.pair_made.get((whole, part[after[j]])):
                    heapq.heappush(queue, (m[0], i, whole, part[after[j]], m[1]))
            if before[i] >= 0 and (m := self.pair_made.get((part[before[i]], whole))):
                heapq.heappush(queue, (m[0], before[i], part[before[i]], whole, m[1]))
        return [p for p, ok in zip(part, alive) if ok]

    def _merge_short(self, part: list[int]) -> list[int]:
        """The same for few symbols, where looking at all pairs again costs less than a queue."""
        get, none = self.pair_made.get, (_NEVER, 0)
        made = [get(pair, none) for pair in zip(part, part[1:])]
        ranks = [m[0] for m in made]
        while ranks and (least := min(ranks)) != _NEVER:
            i = ranks.index(least)
            part[i : i + 2] = [made[i][1]]
            del ranks[i], made[i]
            if i:
                made[i - 1] = m = get((part[i - 1], part[i]), none)
                ranks[i - 1] = m[0]
            if i < len(ranks):
                made[i] = m = get((part[i], part[i + 1]), none)
                ranks[i] = m[0]
        return part

    def cut(self, text: str) -> list[str]:
        """The pre-tokenised words of a text in the byte alphabet. Texts of Latin letters, whose classes and lower case are
        the same in every edition of Unicode, are cut here by the file's own pattern; all others by the library."""
        if self.pattern and (text.isascii() or max(text) < "\u0180"):
            low = text.lower() if text.isascii() else "".join(map(str.lower, unicodedata.normalize("NFC", text)))
            found = self.pattern.findall(low)
            return found if low.isascii() and low.isprintable() else [w.encode("utf-8").decode("latin-1").translate(_BYTES) for w in found]
        text = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def cut_all(self, pieces: set[str]) -> tuple[dict[str, list], dict[str, str]]:
        """The words of each piece, whole numbers for special tokens; and of words that are not yet in the byte alphabet,
        what they are in it. Pieces hold no line end and no blank. Those of Latin letters are cut together, see cut()."""
        cut: dict[str, list] = {}
        latin = []
        for piece in pieces:
            if self.pattern and (piece.isascii() or max(piece) < "\u0180") and not (self.special_split and "<" in piece):
                latin.append(piece)
                continue
            parts = cut[piece] = []
            for k, x in enumerate(self.special_split.split(piece) if self.special_split and "<" in piece else [piece]):
                if k % 2:
                    parts.append(self.special[x])
                elif x:
                    parts.extend(self.cut(x))
        if not latin:
            return cut, {}
        text = "\n".join(latin)
        low = text if text.isascii() else unicodedata.normalize("NFC", text)
        mixed, raw = [], set()
        for piece, line in zip(latin, low.lower().split("\n")):
            if line.isalpha():
                cut[piece] = [line]
                raw.add(line)
            else:
                cut[piece] = []
                mixed.append((piece, line))
        into = iter([cut[piece] for piece, _ in mixed])
        parts = next(into, None)
        for w in self.by_line.findall("\n".join([line for _, line in mixed])):
            if w == "\n":
                parts = next(into)
            else:
                parts.append(w)
                raw.add(w)
        odd = [w for w in raw if not (w.isascii() and w.isprintable())]
        return cut, dict(zip(odd, "\n".join(odd).encode("utf-8").decode("latin-1").translate(_BYTES).split(_BYTES[10])))

    def learn_words(self, words: set[str]) -> dict[str, tuple[int, str, str]]:
        """Number of ids, ids and decoded text of pre-tokenised words: all are proposed, their pairs verified together, and
        the failing ones merged."""
        names = list(words)
        ended = [w + _END for w in names] if self.suffix else names
        proposed = self.propose_all(ended)
        sizes = np.array([len(p) for p in proposed], dtype=np.int64)
        flat = np.array([r for p in proposed for r in p], dtype=np.int64)
        owner = np.repeat(np.arange(len(names)), sizes)
        fails = sizes == 0
        if len(flat):
            inner = np.flatnonzero(owner[1:] == owner[:-1])
            pairs, back = np.unique((flat[inner] << 32) | flat[inner + 1], return_inverse=True)
            good = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[back] if len(pairs) else np.zeros(0, dtype=bool)
            fails[owner[inner[~good]]] = True
            single = self.unsure[flat]
            fails[owner[single]] = True
        of, out = self.shown.__getitem__, {}
        for name, word, p, f in zip(names, ended, proposed, fails.tolist()):
            if f:
                p = self.merge(word)
            if len(p) == 1:
                shown, token = of(p[0])
                out[name] = (1, shown, token or "")
            else:
                shown = list(map(of, p))
                out[name] = (len(p), " ".join([i for i, _ in shown]), " ".join([t for _, t in shown if t is not None]))
        return out

    def learn(self, pieces: set[str]) -> None:
        """Adds what the pieces (texts without blanks and line ends) give to the store."""
        cut, in_bytes = self.cut_all(pieces)
        if len(self.words) > MAX_WORDS:
            self.words.clear()
        known, get = self.words, in_bytes.get
        words = {get(p, p) for parts in cut.values() for p in parts if type(p) is str}
        known.update(self.learn_words(words.difference(known)))
        for piece, parts in cut.items():
            if len(parts) == 1 and type(parts[0]) is str:
                self.pieces[piece] = known[get(parts[0], parts[0])]
                continue
            of = [known[get(p, p)] if type(p) is str else (1, str(p), self.decode([p])) for p in parts]
            self.pieces[piece] = (sum([n for n, _, _ in of]), " ".join([i for _, i, _ in of if i]), " ".join([d for _, _, d in of if d]))

    def encode_texts(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """Number of ids, the ids in decimal with blanks between, and the decoded text, of each text. All three are put
        together from those of the pieces between blanks."""
        cut = [(x or "").replace("\n", " ").split(" ") for x in texts]
        if len(self.pieces) > MAX_PIECES:
            self.pieces.clear()
        new = {p for pieces in cut for p in pieces}.difference(self.pieces)
        if new:
            self.learn(new)
        of = self.pieces.__getitem__
        out = []
        for pieces in cut:
            sizes, ids, decoded = zip(*map(of, pieces))
            # Pieces without ids, and ids unknown to the decoder, leave no blank behind.
            out.append((sum(sizes), " ".join(filter(None, ids)), " ".join(filter(None, decoded))))
        return out

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        return [list(map(int, ids.split())) for _, ids, _ in self.encode_texts(texts)]

    def decode(self, ids: list[int]) -> str:
        """As the library does without a decoder: the tokens with blanks between; unknown ids are left out."""
        of = self.token_of
        return " ".join([of[i] for i in ids if i in of])


def encoder(path: str) -> SpeculativeBpe:
    return kept(("bpe", path), lambda: SpeculativeBpe(path))


def encode_documents(documents: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (if asked for), the ids' and the decoded text's SHA-256 for every row, map-only.

    Null and empty texts have no tokens. Special tokens' strings in a text give their ids. Repeated rows are encoded
    each; other columns are not read; an empty table gives no rows. The vocabulary file must be at `path` on each node.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in in_chunks(texts, 500_000):
                encoded = bpe.encode_texts(texts[a:b])
                columns = [
                    keys.slice(a, b - a),
                    pa.array([n for n, _, _ in encoded], pa.int64()),
                    pa.array([hashlib.sha256(ids.encode()).hexdigest() for _, ids, _ in encoded]),
                    pa.array([hashlib.sha256(decoded.encode("utf-8")).hexdigest() for _, _, decoded in encoded]),
                ] + ([pa.array([list(map(int, ids.split())) for _, ids, _ in encoded], pa.list_(pa.int32()))] if with_ids else [])
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row of documents; see encode_documents for nulls, empty texts and repeated rows."""
    return encode_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), with_ids=False)


QUERIES: dict[str, Callable] = {"op10_bpe": op10_bpe}
ORACLES: dict[str, str] = {}
