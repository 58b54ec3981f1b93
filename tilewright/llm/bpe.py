"""BPE encoding and decoding with a pair occurrence index."""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Chunks and words of a generation that a worker remembers; the one before it is kept as well.
CHUNKS, WORDS = 60_000, 120_000
#: Characters of text that are split into chunks at a time.
STEP = 1 << 20
#: Pairs with fewer positions than this are merged one position after the other.
FEW = 12

# Letters whose lower case the vocabulary's library knows and Python's tables don't,
# and letters and digits of the regex module that are neither to that library.
LATE_LOWER = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}
LATE_LETTERS = (
    r"\U00000558\U0000058B-\U0000058C\U0000088F\U00000C5C\U00000CDC\U0000208F\U0000209D-\U0000209F\U0000A7CE-\U0000A7CF\U0000A7DD\U0000A7E2"
    r"\U0000A7F1\U0000AB6C-\U0000AB6D\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EC7\U00010ED9-\U00010EEE\U00011B0A"
    r"\U00011DB0-\U00011DDB\U00011DE0-\U00011DE9\U00011DF1\U0001246F\U00012475-\U0001247F\U00012550-\U00012686\U00016EA0-\U00016EB8"
    r"\U00016EBB-\U00016ED3\U00016FF2-\U00016FF3\U00016FF4-\U00016FF6\U000187F8-\U000187FF\U00018CD6-\U00018CDA\U00018D09-\U00018D20"
    r"\U00018D80-\U00018DF2\U00018E00-\U00019191\U000191A0-\U000191D2\U0001B123-\U0001B128\U0001B168\U0001D6A6\U0001DF1F-\U0001DF24"
    r"\U0001DF2B-\U0001DF81\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF\U0001E6C0-\U0001E6DE\U0001E6E0-\U0001E6E2\U0001E6E4-\U0001E6E5"
    r"\U0001E6E7-\U0001E6ED\U0001E6F0-\U0001E6F4\U0001E6FE-\U0001E6FF\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD\U000323B0-\U00033479"
    r"\U0003D000-\U0003FC3F"
)


def byte_symbols() -> list[str]:
    """The printable symbol of each byte: itself if printable in Latin-1, else the next free code point from 256."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in keep else next(free)) for b in range(256)]


class Memo:
    """A dict of two generations: when the new one is full it becomes the old one, and what is used again moves over."""

    def __init__(self, generation: int) -> None:
        self.generation = generation
        self.new: dict = {}
        self.old: dict = {}

    def missing(self, keys: set) -> list:
        """The keys that aren't known; those that are stay known until the next call."""
        if len(self.new) > self.generation:
            self.new, self.old = {}, self.new
        new, old, lost = self.new, self.old, []
        for k in keys.difference(new):
            if k in old:
                new[k] = old[k]
            else:
                lost.append(k)
        return lost


class Bpe:
    """A word-end BPE vocabulary: NFC, lower case, split by pattern, byte symbols, merges by rank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pattern = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        # the white space of Unicode, without the separators 1C-1F that \s has here
        pattern = pattern.replace(r"[^\s", r"[^\p{White_Space}") + r"|\n"
        self.pattern = regex.compile(pattern)
        self.late = regex.compile(f"[{LATE_LETTERS}{''.join(map(chr, LATE_LOWER))}]", regex.V1)
        older = {p: rf"[{p}--[{LATE_LETTERS}]]" for p in (r"\p{L}", r"\p{N}")}
        self.late_pattern = regex.compile(pattern.replace(r"\p{L}", older[r"\p{L}"]).replace(r"\p{N}", older[r"\p{N}"]), regex.V1)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        self.mark = regex.compile(b"|".join(regex.escape(m.encode()) for m in self.special))
        ids, end = model["vocab"], model["end_of_word_suffix"]
        names = {i: t for t, i in {**ids, **self.special}.items()}
        self.tokens = [names.get(i, "") for i in range(max(names) + 1)]
        symbols = byte_symbols()
        self.inner, self.last = (np.array([ids[s + e] for s in symbols], np.int32) for e in ("", end))
        merged = [tuple(pair.split(" ") if isinstance(pair, str) else pair) for pair in model["merges"]]
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in merged]
        made = {c: r for r, (_, _, c) in enumerate(self.merges)}
        if len(made) < len(self.merges) or any(made.get(x, -1) >= r for r, (a, b, _) in enumerate(self.merges) for x in (a, b)):
            raise ValueError("a token has several merges or is used by one before its own; ranks can't be applied in one ascending sweep")
        self.rank = {a << 32 | b: r for r, (a, b, _) in enumerate(self.merges)}
        self.by_left, self.by_right = _Sides(self.merges, 0, len(self.tokens)), _Sides(self.merges, 1, len(self.tokens))
        self.decimal = [str(i) for i in range(len(self.tokens))]
        self.chunks, self.words = Memo(CHUNKS), Memo(WORDS)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Token ids (int32) of each word, all words merged together.

        Symbols of all words lie in one linked list. `where` maps the rank of each pair
        present to all its positions; ranks are taken in ascending order, all positions of
        a rank at once, and each merge adds the pairs it makes with its neighbours to their
        lists. No merge makes a pair of lower rank than its own, so one sweep gives each
        word what merging its lowest pair again and again would.
        """
        raw = [w.encode() for w in words]
        flat = np.frombuffer(b"".join(raw), np.uint8)
        n = len(flat)
        ends = np.cumsum([len(r) for r in raw], dtype=np.int64) - 1 if n else np.zeros(0, np.int64)
        starts = np.r_[0, ends[:-1] + 1] if n else ends
        # arrays seen by numpy and, for pairs with few positions, as plain sequences; place n stands for no symbol
        syms, afters, befores = array("i", bytes(4 * n + 4)), array("i", bytes(4 * n + 4)), array("i", bytes(4 * n + 4))
        sym, after, before = (np.frombuffer(x, np.int32) for x in (syms, afters, befores))
        sym[:n], sym[n] = self.inner[flat], -1
        sym[ends] = self.last[flat[ends]]
        after[:n], before[1:] = np.arange(1, n + 1), np.arange(n)
        after[ends], before[starts] = n, n
        where: dict[int, list] = {}
        active: list[int] = []

        def add(at: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for r, part in zip(ranks[np.r_[0, cuts]].tolist(), np.split(at, cuts) if len(cuts) else [at], strict=True):
                if r in where:
                    where[r].append(part)
                else:
                    where[r] = [part]
                    heapq.heappush(active, r)

        def add_one(p: int, r: int | None) -> None:
            if r is not None:
                if r in where:
                    where[r].append((p,))
                else:
                    where[r] = [(p,)]
                    heapq.heappush(active, r)

        at = np.flatnonzero(after[:n] < n).astype(np.int32)
        ranks = self.by_left.ranks(sym[at], sym[at + 1])
        if (ranks >= 0).any():
            add(at[ranks >= 0], ranks[ranks >= 0])
        rank, merges = self.rank.get, self.merges
        while active:
            r = heapq.heappop(active)
            left, right, made = merges[r]
            parts = where.pop(r)
            if left == right or sum(map(len, parts)) < FEW:
                for p in sorted(int(p) for part in parts for p in part):
                    q = afters[p]
                    if syms[p] != left or syms[q] != right:
                        continue
                    syms[p], syms[q] = made, -1
                    q = afters[p] = afters[q]
                    if q < n:
                        befores[q] = p
                        add_one(p, rank(made << 32 | syms[q]))
                    if (q := befores[p]) < n:
                        add_one(q, rank(syms[q] << 32 | made))
                continue
            at = np.concatenate(parts) if len(parts) > 1 else parts[0]
            nxt = after[at]
            fine = (sym[at] == left) & (sym[nxt] == right)
            at, nxt = at[fine], nxt[fine]
            sym[at], sym[nxt] = made, -1
            nxt = after[at] = after[nxt]
            before[nxt] = at
            prev = before[at]
            ranks = np.concatenate([self.by_left.ranks_of(made, sym[nxt]), self.by_right.ranks_of(made, sym[prev])])
            fine = ranks >= 0
            if fine.any():
                add(np.concatenate([at, prev])[fine], ranks[fine])
        kept = sym[:n] >= 0
        ids = sym[:n][kept].tobytes()
        stop = np.cumsum(np.add.reduceat(kept, starts, dtype=np.int64) * 4).tolist() if n else []
        return [ids[a:b] for a, b in zip([0, *stop[:-1]], stop, strict=True)] if n else []

    def _split(self, text: str) -> list[str]:
        """The words of a text, and its line feeds."""
        # lower() would write a final capital sigma differently from letter to letter
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        if not text.isascii() and self.late.search(text):
            return self.late_pattern.findall(text.translate(LATE_LOWER).lower())
        return self.pattern.findall(text.lower())

    def _marked(self, text: str) -> Iterator[str | int]:
        """Words and ids of special tokens of a chunk that holds some."""
        at = 0
        for m in self.special_at.finditer(text):
            yield from (*self._split(text[at : m.start()]), self.special[m[0]])
            at = m.end()
        yield from self._split(text[at:])

    def learn(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        """A dict with the token ids of each chunk; a chunk is a run of anything but white space of ASCII."""
        new = self.chunks.missing(chunks)
        marked = {c: list(self._marked(c.decode())) for c in new if self.mark.search(c)}
        plain = [c for c in new if c not in marked] if marked else new
        pieces = self._split(b"\n".join(plain).decode()) if plain else []
        words = {*pieces, *(p for found in marked.values() for p in found if isinstance(p, str))}
        words.discard("\n")
        words = self.words.missing(words)
        known, held = self.words.new, self.chunks.new
        known.update(zip(words, self.encode_words(words), strict=True))
        # -1 stands where a chunk ends
        end = array("i", [-1]).tobytes()
        ids = b"".join([known[p] if p != "\n" else end for p in pieces])
        cuts = np.flatnonzero(np.frombuffer(ids, np.int32) == -1) * 4
        stops = [*cuts.tolist(), len(ids)]
        held.update((c, ids[a:b]) for c, a, b in zip(plain, [0, *(cuts + 4).tolist()], stops, strict=False))
        for c, found in marked.items():
            held[c] = b"".join([known[p] if isinstance(p, str) else array("i", [p]).tobytes() for p in found])
        return held

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text."""
        cut = [t.encode("utf-8", "replace").split() for t in texts]
        held = self.learn({c for x in cut for c in x})
        return [np.frombuffer(b"".join(map(held.__getitem__, x)), np.int32) for x in cut]


class _Sides:
    """Ranks of merges by the token on one side, as sorted arrays: which 0 by the left one, 1 by the right one."""

    def __init__(self, merges: list[tuple[int, int, int]], which: int, n: int):
        pairs = np.array([(m[which], m[1 - which]) for m in merges], np.int64).reshape(-1, 2)
        self.order = np.lexsort((pairs[:, 1], pairs[:, 0]))
        self.keys = pairs[self.order, 0] << 32 | pairs[self.order, 1]
        self.others = pairs[self.order, 1].astype(np.int32)
        self.bounds = np.searchsorted(pairs[self.order, 0], np.arange(n + 1)).tolist()

    def ranks(self, tokens: np.ndarray, others: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 if it is none."""
        want = tokens.astype(np.int64) << 32 | others
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.order[at], -1)

    def ranks_of(self, token: int, others: np.ndarray) -> np.ndarray:
        lo, hi = self.bounds[token], self.bounds[token + 1]
        if lo == hi:
            return np.full(len(others), -1)
        near = self.others[lo:hi]
        at = np.minimum(np.searchsorted(near, others), hi - lo - 1)
        return np.where(near[at] == others, self.order[lo:hi][at], -1)


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Bpe:
    return Bpe(path)


def _steps(texts: list[str]) -> Iterator[list[str]]:
    held: list[str] = []
    size = 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size > STEP:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode(docs: DataFrame, path: str = VOCABULARY, full: bool = True, decoded: bool = True) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_tokens, ids, decoded) of each whole text; null counts as empty.

    ids is an array of token ids as the vocabulary's own library gives them without
    special tokens of its making; a special token spelt out in a text is that token.
    decoded (left out on decoded=False) is the tokens' own strings joined by a space, as
    decoding without a decoder gives. With full=False the ids and decoded texts give way
    to their SHA-256, ids_sha256 (decimal, joined by a space) and decoded_sha256.

    One row per row of docs: rows that repeat and null ids stay as they are, texts of any
    length are encoded whole, an empty table gives an empty one, and other columns of
    docs, whatever their names, take no part.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id long, n_tokens long, " + ("ids array<int>" if full else "ids_sha256 string")
    if decoded:
        schema += ", decoded string" if full else ", decoded_sha256 string"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        spelt = lambda names, ids: [" ".join(map(names.__getitem__, i.tolist())) for i in ids]
        digests = lambda texts: pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())
        for batch in (b.slice(a, 512) for b in batches for a in range(0, b.num_rows, 512)):
            at = 0
            for texts in _steps([t or "" for t in batch.column(1).to_pylist()]):
                ids = bpe.encode(texts)
                columns = [batch.column(0).slice(at, len(texts)), pa.array([len(i) for i in ids], pa.int64())]
                at += len(texts)
                columns.append(pa.array(ids, pa.list_(pa.int32())) if full else digests(spelt(bpe.decimal, ids)))
                if decoded:
                    columns.append(pa.array(spelt(bpe.tokens, ids), pa.string()) if full else digests(spelt(bpe.tokens, ids)))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), full=False)
