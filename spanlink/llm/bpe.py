"""Operator 6: byte-level BPE encoding with a pair occurrence index, and decoding.

The pieces of text that a batch needs and that aren't remembered are laid out as one array of symbols. An index maps
each mergeable pair, by its rank, to all its positions there. The active ranks are applied in ascending order; a merge
updates the lists of the pairs to its left and right. As a merge only makes pairs of higher rank (checked when a vocabulary
is loaded), one pass over the ranks does for all pieces what merging piece by piece would do.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlink.llm.common import slices, text_bytes

#: The pre-tokenizer's pattern (fixed value of the public vocabulary's format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Segments and pieces whose ids a worker remembers.
MEMO = 120_000
#: Characters of text encoded at once.
BATCH = 2_000_000
#: Below this rank, where lists of positions are long, a merge is applied to a whole list by numpy; above, position by position.
LONG_LISTS = 2_500


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, the rest from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Merges, ids and bytes of a byte-level BPE tokenizer file, and what a worker remembers of it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            t = json.load(f)
        pre, model = t["pre_tokenizer"] or {}, t["model"]
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not t["normalizer"]
        if not plain or model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix") or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError(f"{path} isn't a plain byte-level BPE tokenizer")
        chars, vocab = byte_symbols(), model["vocab"]
        self.first = np.zeros(256, np.int64)
        for c, b in chars.items():
            self.first[b] = vocab[c]
        self.merges: list[tuple[int, int, int]] = []
        self.rank: dict[int, int] = {}
        made: dict[int, int] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            new = vocab[a + b]
            if made.get(vocab[a], -1) >= r or made.get(vocab[b], -1) >= r or new in made:
                raise ValueError(f"merge {r} isn't in order")
            made[new] = r
            self.merges.append((vocab[a], vocab[b], new))
            self.rank[vocab[a] << 32 | vocab[b]] = r
        self.added = {a["content"]: a["id"] for a in t["added_tokens"]}
        for a in t["added_tokens"]:
            if a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"]:
                raise ValueError(f"added token {a['content']!r} needs more than its literal text")
        self.bytes = [b""] * (max([*vocab.values(), *self.added.values()]) + 1)
        for token, i in [*vocab.items(), *self.added.items()]:
            known = all(c in chars for c in token)
            self.bytes[i] = bytes(chars[c] for c in token) if known else token.encode()
        self.pattern = regex.compile(PATTERN)
        literal = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, literal)) + ")") if literal else None
        self.segments: dict[str, bytes | None] = {}  # None: white space at an edge, so the segment depends on its neighbours
        self.pieces: dict[str, bytes] = {}

    # -- pieces ---------------------------------------------------------------------------------------

    def split(self, text: str) -> list[str]:
        """The pre-tokenizer's pieces; added tokens are pieces of their own."""
        if self.special is None or not self.special.search(text):
            return self.pattern.findall(text)
        out: list[str] = []
        for i, part in enumerate(self.special.split(text)):
            out += [part] if i % 2 else self.pattern.findall(part)
        return out

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as packed little-endian 32-bit integers, by the pair occurrence index."""
        if not pieces:
            return []
        flat = np.frombuffer(b"\0" + b"\0".join(pieces) + b"\0", np.uint8)
        lengths = np.array([len(p) for p in pieces])
        stops = np.concatenate([[0], np.cumsum(lengths + 1)])  # a stop in front of each piece and at the end
        symbols = self.first[flat]
        symbols[stops] = -1
        pair = symbols[:-1] << 32 | symbols[1:]
        pair[(symbols[:-1] < 0) | (symbols[1:] < 0)] = -1
        unique, inverse = np.unique(pair, return_inverse=True)
        of = self.rank.get
        ranks = np.array([of(k, -1) for k in unique.tolist()])[inverse]
        at = np.flatnonzero(ranks >= 0)
        at = at[np.argsort(ranks[at], kind="stable")]
        index: dict[int, list] = {}
        if len(at):
            found, begin = np.unique(ranks[at], return_index=True)
            index = {r: [x] for r, x in zip(found.tolist(), np.split(at, begin[1:]), strict=True)}
        heap = list(index)
        heapq.heapify(heap)
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        while heap and heap[0] < LONG_LISTS:
            r = heapq.heappop(heap)
            a, b, new = self.merges[r]
            i = np.concatenate(lists) if len(lists := index.pop(r)) > 1 else lists[0]
            i = i[symbols[i] == a]
            i = i[symbols[after[i]] == b]
            if a == b:  # of overlapping pairs the left one is merged
                kept, taken = [], -1
                for x, y in sorted({*zip(i.tolist(), after[i].tolist(), strict=True)}):
                    if x != taken:
                        kept.append(x)
                        taken = y
                i = np.array(kept, np.int64)
            elif len(lists) > 1:
                i = np.unique(i)
            if not len(i):
                continue
            j = after[i]
            k = after[j]
            symbols[i], symbols[j] = new, -2
            after[i], before[k] = k, i
            left = before[i]
            for first, second, where in ((symbols[left], np.full(len(i), new), left), (np.full(len(i), new), symbols[k], i)):
                pair = first << 32 | second
                pair[(first < 0) | (second < 0)] = -1
                order = np.argsort(pair, kind="stable")
                pair, where = pair[order], where[order]
                begin = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
                for key, places in zip(pair[begin].tolist(), np.split(where, begin[1:]), strict=True):
                    if (q := of(key)) is not None:
                        if q in index:
                            index[q].append(places)
                        else:
                            index[q] = [places]
                            heapq.heappush(heap, q)
        s, after, before = symbols.tolist(), after.tolist(), before.tolist()
        index = {r: [x for places in lists for x in places.tolist()] for r, lists in index.items()}
        while heap:
            r = heapq.heappop(heap)
            a, b, new = self.merges[r]
            for i in sorted(index.pop(r)):
                if s[i] != a:
                    continue
                j = after[i]
                if s[j] != b:
                    continue
                k = after[j]
                s[i], s[j] = new, -2
                after[i], before[k] = k, i
                x = s[before[i]]
                if x >= 0 and (q := of(x << 32 | new)) is not None:
                    if q in index:
                        index[q].append(before[i])
                    else:
                        index[q] = [before[i]]
                        heapq.heappush(heap, q)
                x = s[k]
                if x >= 0 and (q := of(new << 32 | x)) is not None:
                    if q in index:
                        index[q].append(i)
                    else:
                        index[q] = [i]
                        heapq.heappush(heap, q)
        out = np.array(s)
        alive = out >= 0
        ends = (np.cumsum(alive)[stops] * 4).tolist()
        raw = out[alive].astype("<u4").tobytes()
        return [raw[x:y] for x, y in zip(ends, ends[1:], strict=False)]

    # -- texts ----------------------------------------------------------------------------------------

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, packed.

        A single space between two characters that aren't white space always begins a piece, so a text falls into
        segments there whose ids don't depend on each other. Texts with other spaces are split as a whole.
        """
        if len(self.segments) > MEMO:
            self.segments.clear()
        if len(self.pieces) > MEMO:
            self.pieces.clear()
        known, pieces = self.segments, self.pieces
        parted = []
        for text in texts:
            words = text.split(" ")
            words[0] = "\0" + words[0]  # the first segment has no space in front
            parted.append(words)
        cut: dict[str, list[str]] = {}
        for w in set().union(*parted) - known.keys():
            own = w[1:] if w[:1] == "\0" else w
            if not own or own[0].isspace() or own[-1].isspace():
                known[w] = None
            else:
                cut[w] = self.split(own if own is not w else " " + w)
        self.remember(p for ps in cut.values() for p in ps)
        for w, ps in cut.items():
            known[w] = b"".join([pieces[p] for p in ps])
        out: list[bytes] = []
        whole: dict[int, list[str]] = {}
        for i, words in enumerate(parted):
            try:
                out.append(b"".join(map(known.__getitem__, words)))
            except TypeError:
                out.append(b"")
                whole[i] = self.split(texts[i])
        if whole:
            self.remember(p for ps in whole.values() for p in ps)
            for i, ps in whole.items():
                out[i] = b"".join(map(pieces.__getitem__, ps))
        return out

    def remember(self, pieces) -> None:
        need = set(pieces) - self.pieces.keys()
        added = need & self.added.keys()
        for p in added:
            self.pieces[p] = np.array([self.added[p]], "<u4").tobytes()
        todo = list(need - added)
        self.pieces.update(zip(todo, self.merge([p.encode() for p in todo]), strict=True))

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def bpe_encode(docs: DataFrame, path: str, packed: bool = False, decoded: bool = False) -> DataFrame:
    """doc_id, ids: the ids of each whole text, as the tokenizer file at path gives them without special tokens added.

    docs has doc_id and text; other columns are ignored. ids are an array of integers, or if packed bytes: little-endian
    unsigned 32-bit integers. If decoded, the column text has what the ids decode to, as bpe_decode() gives it. A null text
    counts as empty and has no ids. A row a document, in any order; no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in slices(batches, 1024):
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end] or "") <= BATCH):
                    size += len(texts[end] or "")
                    end += 1
                ids = v.encode([x or "" for x in texts[at:end]])
                if packed:
                    column = pa.array(ids, pa.binary())
                else:
                    offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])])
                    column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32)))
                out = {"doc_id": pa.array(doc_ids[at:end], pa.int64()), "ids": column}
                if decoded:
                    out["text"] = pa.array([v.decode(np.frombuffer(x, "<u4")) for x in ids], pa.string())
                yield pa.record_batch(list(out.values()), list(out))
                at = end

    schema = f"doc_id long, ids {'binary' if packed else 'array<int>'}" + ", text string" * decoded
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """encoded (doc_id, ids packed) with the column text: what the ids stand for, special tokens included.

    Bytes that aren't UTF-8 become U+FFFD. Null ids count as none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in slices(batches):
            texts = [v.decode(np.frombuffer(x, "<u4")) for x in text_bytes(batch.column(1))]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")
