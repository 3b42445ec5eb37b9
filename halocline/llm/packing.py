"""Hierarchical multi-length packing of tokenized documents.

Documents are routed by length to context-size tiers.  Windows of each tier are opened by documents of that
tier, their gaps are filled from shorter tiers (whole documents while they fit, then one cut), and finished
sequences are dealt to step groups of equal token counts.  Every task packs the rows of its own partition as a
stream, so there is no shuffle and memory does not depend on the partition's size; what is left at a
partition's end, less than one longest window, is cut into powers of two, so no sequence needs padding; these last
sequences of a partition may be shorter than the shortest tier, down to one token.

Edge cases: a null or empty text is one document holding only the end token; a null ``doc_id`` is kept as
null; repeated rows are packed once each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halocline.llm.common import read_table, small_batches

TIERS = (512, 1024, 2048, 4096)
END_ID = 2
#: Sequences are packed from buffers of about this many tokens.
BUFFER_TOKENS = 262_144
#: Tokens of one training step; the sequences of a buffer are dealt to steps of about this size.
STEP_TOKENS = 32_768
#: Distinct space-separated strings a task keeps ids for before it starts afresh.
CACHE_WORDS = 600_000

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step_id long"


class Slots(dict):
    """Numbers strings in the order in which they are first asked for."""

    def __init__(self) -> None:
        super().__init__({"": 0})
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = slot = len(self)
        self.new.append(word)
        return slot

    def take_new(self) -> list[str]:
        new, self.new = self.new, []
        return new


class Ragged:
    """Rows of ids in one array."""

    def __init__(self) -> None:
        self.flat = np.zeros(0, np.uint32)
        self.lens = np.zeros(1, np.int64)
        self.at = np.zeros(1, np.int64)

    def extend(self, flat: np.ndarray, lens: np.ndarray) -> None:
        self.at = np.concatenate((self.at, len(self.flat) + np.cumsum(lens) - lens))
        self.flat, self.lens = np.concatenate((self.flat, flat)), np.concatenate((self.lens, lens))

    def rows(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of these slots one after the other, and where each ends."""
        lens = self.lens[slots]
        ends = np.cumsum(lens)
        return self.flat[np.repeat(self.at[slots] - ends + lens, lens) + np.arange(ends[-1] if len(ends) else 0)], ends


class WordIds:
    """ids of whole texts, each distinct space-separated string encoded once.

    The vocabulary's pre-tokenizer never joins text over white space and its normalizer works on single
    characters around a space, so a text's ids are those of its space-separated strings in order.  A string of
    Latin-1 letters and closing punctuation is two pre-tokens, which are encoded once each.
    """

    CLOSING = ".,!?;:|"

    def __init__(self, path: str, keep: int = CACHE_WORDS) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # every string comes once
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.keep = keep
        self.clear()

    def clear(self) -> None:
        self.words, self.word_ids = Slots(), Ragged()
        self.parts, self.part_ids = Slots(), Ragged()

    def learn_parts(self, parts: list[str], latin: bool) -> None:
        alone = [p.isalpha() and (latin or max(p) < "Ā") for p in parts]
        letters = [p for p, a in zip(parts, alone, strict=True) if a]
        found: list[np.ndarray] = []
        for k in range(0, len(letters), 500):  # each is one pre-token, and ends with its only </w>
            found.append(np.array(self.tokenizer.encode(" ".join(letters[k : k + 500]), add_special_tokens=False).ids, np.uint32))
        flat = np.concatenate(found) if found else np.zeros(0, np.uint32)
        stops = np.flatnonzero(self.ends[flat]) + 1
        assert len(stops) == len(letters)
        others = [e.ids for e in self.tokenizer.encode_batch([p for p, a in zip(parts, alone, strict=True) if not a], add_special_tokens=False)]
        # in the order of their slots: letters and others are laid down apart, then gathered
        both = Ragged()
        both.extend(np.concatenate((flat, np.array([i for ids in others for i in ids], np.uint32))), np.concatenate((np.diff(stops, prepend=0), np.array([len(ids) for ids in others], np.int64))))
        alone = np.array(alone, bool)
        slots = np.where(alone, np.cumsum(alone), len(letters) + np.cumsum(~alone))
        ids, ends = both.rows(slots)
        self.part_ids.extend(ids, np.diff(ends, prepend=0))

    def learn(self, words: list[str]) -> None:
        joined = "\n".join(words)  # no word has a line break
        try:
            joined.encode("latin-1")
            lows = joined.lower().split("\n")
        except UnicodeEncodeError:
            lows = [w.lower() if max(w) < "Ā" else "" for w in words]
        parts: list[str] = []
        for word, low in zip(words, lows, strict=True):
            core = low.rstrip(self.CLOSING)
            if core.isalpha():
                parts += (core, low[len(core) :])
            else:
                parts += (word, "")
        slots = np.fromiter(map(self.parts.__getitem__, parts), np.int64, len(parts))
        if new := self.parts.take_new():
            self.learn_parts(new, joined.isascii() or max(joined) < "Ā")
        ids, ends = self.part_ids.rows(slots)
        self.word_ids.extend(ids, np.diff(ends[1::2], prepend=0))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.words) > self.keep:
            self.clear()
        counts, flat = [], []
        for t in texts:
            words = t.replace("\n", " ").split(" ") if t else []
            counts.append(len(words))
            flat += words
        slots = np.fromiter(map(self.words.__getitem__, flat), np.int64, len(flat))
        if new := self.words.take_new():
            self.learn(new)
        ids, ends = self.word_ids.rows(slots)
        stops = np.concatenate(([0], ends))[np.cumsum(counts)].tolist()
        return [ids[a:b] for a, b in zip([0, *stops], stops, strict=False)]


class PlainIds:
    """ids of whole texts by the tokenizer alone, for any vocabulary."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


# The steps of the vocabulary for which WordIds has been shown to give the ids of whole texts.
PROVEN = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}
PROVEN_MODEL = {"type": "BPE", "end_of_word_suffix": "</w>", "dropout": None, "continuing_subword_prefix": None, "byte_fallback": False}


def word_by_word(path: str) -> bool:
    """Whether a tokenizer file has exactly the steps that WordIds relies on, and no added token with white space."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    steps = all(file.get(k) == v for k, v in PROVEN.items()) and all(file["model"].get(k) == v for k, v in PROVEN_MODEL.items())
    return steps and not any(len(t["content"].split()) != 1 for t in file.get("added_tokens") or [])


def ids_of(path: str) -> WordIds | PlainIds:
    return WordIds(path) if word_by_word(path) else PlainIds(path)


class TierPacker:
    """Packs pieces (key, start, length) into sequences whose lengths are tiers, or powers of two at the end."""

    def __init__(self, tiers: tuple[int, ...] = TIERS) -> None:
        self.tiers = tuple(sorted(tiers))
        self.pools = {t: deque() for t in self.tiers}
        self.tokens = 0

    def put(self, piece: tuple) -> None:
        """A piece of 1 to longest-tier tokens, to the smallest tier that holds it."""
        self.pools[next(t for t in self.tiers if t >= piece[2])].append(piece)
        self.tokens += piece[2]

    def add(self, key: int, length: int) -> Iterator[list[tuple]]:
        """A document; windows that it fills alone are returned at once."""
        top = self.tiers[-1]
        for start in range(0, length - length % top, top):
            yield [(key, start, top)]
        if length % top:
            self.put((key, length - length % top, length % top))

    def take(self, tier: int, gap: int) -> tuple:
        """The next piece for a gap in a window of ``tier``: the longest that fits, else one cut to fit."""
        for t in reversed([t for t in self.tiers if t <= tier]):
            if self.pools[t] and self.pools[t][0][2] <= gap:
                piece = self.pools[t].popleft()
                self.tokens -= piece[2]
                return piece
        pool = next(self.pools[t] for t in self.tiers if self.pools[t])
        key, start, length = pool.popleft()
        self.tokens -= length
        if length > gap:
            self.put((key, start + gap, length - gap))
        return key, start, min(gap, length)

    def window(self, tier: int, size: int) -> list[tuple]:
        pieces, gap = [], size
        while gap:
            pieces.append(self.take(tier, gap))
            gap -= pieces[-1][2]
        return pieces

    def pack(self, last: bool) -> Iterator[list[tuple]]:
        for tier in reversed(self.tiers):
            while self.pools[tier] and self.tokens >= tier:
                yield self.window(tier, tier)
        if last:
            while self.tokens:
                yield self.window(self.tiers[-1], 1 << (min(self.tokens, self.tiers[-1]).bit_length() - 1))


def deal_steps(lengths: list[int], step_tokens: int) -> list[int]:
    """A step group for each sequence: the longest go first, each to the group with the fewest tokens."""
    groups = [(0, g) for g in range(max(1, round(sum(lengths) / step_tokens)))]
    out = [0] * len(lengths)
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        total, g = groups[0]
        out[k] = g
        heapq.heapreplace(groups, (total + lengths[k], g))
    return out


def pack(docs: DataFrame, tokenizer_path: str, tiers: tuple[int, ...] = TIERS, end_id: int = END_ID, buffer_tokens: int = BUFFER_TOKENS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """Pieces of all documents with their ids (little-endian unsigned 32-bit), sequence and step group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = ids_of(tokenizer_path), TierPacker(tiers)
        base = TaskContext.get().partitionId() << 33
        held: dict[int, list] = {}  # key: doc_id, ids, tokens not yet emitted
        keys = sequences = steps = 0
        ready: list[list[tuple]] = []

        def emit() -> pa.RecordBatch:
            nonlocal sequences, steps
            rows = []
            groups = deal_steps([sum(p[2] for p in s) for s in ready], step_tokens)
            for s, group in zip(ready, groups, strict=True):
                size, offset = sum(p[2] for p in s), 0
                for key, start, length in s:
                    doc_id, ids, left = held[key]
                    rows.append((doc_id, start, length, ids[start : start + length].tobytes(), len(ids), base + sequences, offset, size, base + steps + group))
                    offset += length
                    held[key][2] = left - length
                    if left == length:
                        del held[key]
                sequences += 1
            steps += max(groups, default=-1) + 1
            ready.clear()
            cols = list(zip(*rows, strict=True))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

        waiting = 0
        for batch in small_batches(batches, 1, 1_000_000):
            encoded = words.encode(batch.column(1).to_pylist())
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                held[keys] = [doc_id, ids, len(ids)]
                ready.extend(packer.add(keys, len(ids)))
                keys += 1
                waiting += len(ids)
            if waiting >= buffer_tokens:
                ready.extend(packer.pack(last=False))
                waiting = 0
                if ready:
                    yield emit()
        ready.extend(packer.pack(last=True))
        if ready:
            yield emit()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(read_table(spark, sf_dir, "documents"), tokenizer_file())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_id")
