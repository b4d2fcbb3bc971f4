"""BPE by a word lexicon in a minimal acyclic transducer, with exact merging of other words.

The words that are frequent in the corpus, with the ids their merges end in, are compiled into
an automaton whose equal suffixes are shared. Each arc carries a part of the word's number, and
the parts along a path add up to it, so the words of a shared suffix still end in ids of their
own. The automaton is a file of plain arrays that tasks map into memory. Words it does not hold
are merged by the tokenizer's rules, so every text gets exactly the tokenizer's ids.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.shared import lean, write_bytes
from tidewright.llm.words import Chunks, Recent, slices
from tidewright.session import work_folder

# Most frequent runs of letters that are compiled, and the longest; the file takes less than 100
# bytes for each.
LEXICON_WORDS = 100_000
LEXICON_LENGTH = 40
# Pieces and chunks a task remembers (twice as many at most).
CACHED_CHUNKS = 30_000
# Text worked on at a time; each distinct chunk of it is held in three forms.
SLICE_BYTES = 4 << 20


class Rules:
    """The merge rules of a BPE tokenizer file, for the settings this operator knows.

    Anything else in the file (another normalizer, pattern, post-processor or decoder, dropout)
    is refused rather than guessed at.
    """

    def __init__(self, file_text: str):
        file = json.loads(file_text)
        model = file["model"]
        steps = [s["type"] for s in file["normalizer"]["normalizers"]]
        splits = file["pre_tokenizer"]["pretokenizers"]
        known = (
            steps == ["NFC", "Replace", "Lowercase"]
            and [s["type"] for s in splits] == ["Split", "ByteLevel"]
            and splits[0]["behavior"] == "Removed" and splits[0]["invert"]
            and not splits[1]["add_prefix_space"] and not splits[1]["use_regex"]
            and model["type"] == "BPE" and not model["dropout"] and not model["byte_fallback"]
            and not model["continuing_subword_prefix"] and not model["ignore_merges"]
            and file["post_processor"] is None and file["decoder"] is None
            and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]
                        for t in file["added_tokens"])
        )
        if not known:
            raise ValueError("a tokenizer file of another kind")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {tuple(p): i for i, p in enumerate(pairs)}
        self._prepare_pairs(pairs)
        self.pieces = regex.compile(splits[0]["pattern"]["Regex"])
        self.added: dict[str, int] = {t["content"]: t["id"] for t in file["added_tokens"]}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, longest_first))) if self.added else None
        self.names = {i: t for t, i in {**self.vocab, **self.added}.items()}
        self.letters = _byte_letters()

    def _prepare_pairs(self, pairs: list[list[str]]) -> None:
        """Arrays for merging many pieces at a time, by ids.

        A merge whose parts were made by earlier merges only ever makes pairs of a later rank, so
        all places of a pair can be joined at once. A file without that order is refused.
        """
        letters = _byte_letters()
        made = {x for c in letters for x in (c, c + self.suffix)}
        for a, b in pairs:
            if a not in made or b not in made:
                raise ValueError("a merge of parts that no earlier merge makes")
            made.add(a + b)
        ids = np.array([[self.vocab[a], self.vocab[b], self.vocab[a + b]] for a, b in pairs], np.int64)
        ids = ids.reshape(len(pairs), 3)
        keys = ids[:, 0] << 32 | ids[:, 1]
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks, self.pair_made = keys[order], order.astype(np.int64), ids[order, 2]
        self.first_ids = np.array([self.vocab[c] for c in letters], np.int64)
        self.last_ids = np.array([self.vocab[c + self.suffix] for c in letters], np.int64)

    def merged(self, pieces: list[str]) -> list[list[int]]:
        """Ids of each piece: its lowest-ranked pair is joined, leftmost first, until none is left."""
        short = [p for p in pieces if len(p) <= LEXICON_LENGTH]
        found = dict(zip(short, self._merged_short(short), strict=True))
        return [found[p] if p in found else _merged_by_heap(self, p) for p in pieces]

    def _merged_short(self, pieces: list[str]) -> list[list[int]]:
        data = [p.encode() for p in pieces]
        lengths = np.array([len(d) for d in data], np.int64)
        letters = np.frombuffer(b"".join(data), np.uint8)
        parts, word = self.first_ids[letters], np.repeat(np.arange(len(data)), lengths)
        last = np.cumsum(lengths) - 1
        parts[last] = self.last_ids[letters[last]]
        none, done = len(self.pair_ranks), []
        while len(parts):
            keys = parts[:-1] << 32 | parts[1:]
            at = np.minimum(np.searchsorted(self.pair_keys, keys), none - 1)
            ranks = np.full(len(parts), none)
            hit = (self.pair_keys[at] == keys) & (word[:-1] == word[1:])
            ranks[:-1][hit] = self.pair_ranks[at[hit]]
            begins = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.repeat(np.minimum.reduceat(ranks, begins), np.diff(np.r_[begins, len(parts)]))
            over = best == none
            done.append((word[over], parts[over]))
            joins = np.flatnonzero((ranks == best) & ~over)
            # In a run of overlapping places every second one is joined, from the left.
            fresh = np.r_[True, np.diff(joins) > 1] if len(joins) else joins.astype(bool)
            place = np.arange(len(joins))
            joins = joins[(place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0]
            parts[joins] = self.pair_made[at[joins]]
            keep = ~over
            keep[joins + 1] = False
            parts, word = parts[keep], word[keep]
        words = np.concatenate([w for w, _ in done]) if done else np.empty(0, np.int64)
        ids = np.concatenate([p for _, p in done]) if done else words
        order = np.argsort(words, kind="stable")
        cuts = np.searchsorted(words[order], np.arange(len(pieces) + 1)).tolist()
        ids = ids[order].tolist()
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def split(self, chunk: str) -> list[str | int]:
        """The pieces of a run without ASCII white space, and the ids of its special tokens."""
        if self.special is None or "<" not in chunk:
            return self._plain(chunk)
        found: list[str | int] = []
        at = 0
        for special in self.special.finditer(chunk):
            found += [*self._plain(chunk[at : special.start()]), self.added[special.group()]]
            at = special.end()
        return found + self._plain(chunk[at:])

    def _plain(self, text: str) -> list[str]:
        # Below U+0250 no letter joins or splits, and lower() treats each by itself.
        if text.isalpha() and (text.isascii() or max(text) < "\u0250"):
            low = text.lower()
            if low.isalpha():
                return [low]
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # Letter by letter: lower() of a whole string treats a final sigma in a way of its own.
        return self.pieces.findall("".join(c.lower() for c in text))


def _byte_letters() -> list[str]:
    """The printable letter byte-level BPE writes for each byte: itself, or the next from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, extra = [], 256
    for b in range(256):
        letters.append(chr(b if b in plain else extra))
        extra += b not in plain
    return letters


def _merged_by_heap(rules: Rules, piece: str) -> list[int]:
    """The same merges for very long pieces, with a heap of pairs and linked parts."""
    import heapq

    parts = [rules.letters[b] for b in piece.encode()]
    parts[-1] += rules.suffix
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))

    def pair(at: int) -> tuple[int, int, str, str] | None:
        if at < 0 or after[at] >= len(parts):
            return None
        two = (parts[at], parts[after[at]])
        rank = rules.ranks.get(two)
        return None if rank is None else (rank, at, *two)

    heap = [p for p in map(pair, range(len(parts))) if p]
    heapq.heapify(heap)
    while heap:
        _, at, left, right = heapq.heappop(heap)
        if parts[at] != left or after[at] >= len(parts) or parts[after[at]] != right:
            continue
        gone = after[at]
        parts[at], parts[gone], after[at] = left + right, "", after[gone]
        if after[at] < len(parts):
            before[after[at]] = at
        for p in (pair(before[at]), pair(at)):
            if p:
                heapq.heappush(heap, p)
    return [rules.vocab[p] for p in parts if p]


class Lexicon:
    """The automaton: words are looked up many at a time, letter by letter over all of them.

    Arcs are rows of (state, byte) kept in order, with the state they lead to and the number they
    add. A word is in the lexicon if its bytes lead to a final state; the numbers added on the way
    are its place among the words in order, which gives its slice of the ids.
    """

    FIELDS = ("arcs", "targets", "adds", "final", "starts", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        for name in self.FIELDS:
            setattr(self, name, arrays[name])

    @classmethod
    def compiled(cls, words: dict[str, list[int]]) -> Lexicon:
        """Builds the minimal automaton from words in byte order: a state is frozen when the next
        word leaves it, and replaced by an equal frozen state if there is one."""
        order = sorted(words, key=str.encode)
        register: dict[tuple, int] = {}
        frozen: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
        counts: list[int] = []

        def freeze(final: bool, arcs: list[tuple[int, int]]) -> int:
            key = (final, tuple(arcs))
            if key not in register:
                register[key] = len(frozen)
                frozen.append(key)
                counts.append(int(final) + sum(counts[t] for _, t in arcs))
            return register[key]

        # The path of the word before: one open state per letter.
        path: list[list] = [[False, []]]
        last = b""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs = path.pop()
                path[-1][1].append((last[len(path) - 1], freeze(final, arcs)))

        for word in order:
            data = word.encode()
            shared = os.path.commonprefix([data, last])
            close(len(shared))
            path.extend([False, []] for _ in data[len(shared) :])
            path[-1][0] = True
            last = data
        close(0)
        root = freeze(*path[0])
        # The root becomes state 0, so that a lookup starts there.
        number = {root: 0}
        for state in range(len(frozen)):
            number.setdefault(state, len(number))
        rows = []
        for state, (final, arcs) in enumerate(frozen):
            passed = int(final)
            for letter, target in arcs:
                rows.append(((number[state] << 8) | letter, number[target], passed))
                passed += counts[target]
        rows.sort()
        table = np.array(rows, np.int64).reshape(len(rows), 3)
        final = np.zeros(len(frozen), bool)
        for state, (ends, _) in enumerate(frozen):
            final[number[state]] = ends
        lengths = [len(words[w]) for w in order]
        return cls({
            "arcs": table[:, 0].copy(), "targets": table[:, 1].copy(), "adds": table[:, 2].copy(),
            "final": final, "starts": np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]),
            "ids": np.array([i for w in order for i in words[w]], np.int32),
        })

    @property
    def states(self) -> int:
        return len(self.final)

    def to_bytes(self) -> bytes:
        head = json.dumps([[n, str(self.arrays[n].dtype), len(self.arrays[n])] for n in self.FIELDS])
        body = b"".join(a.tobytes() + bytes(-len(a.tobytes()) % 8) for a in
                        (np.ascontiguousarray(self.arrays[n]) for n in self.FIELDS))
        head = head.encode() + b" " * (-len(head.encode()) % 8)
        return len(head).to_bytes(8, "little") + head + body

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        data = np.memmap(path, np.uint8, "r")
        size = int.from_bytes(data[:8].tobytes(), "little")
        arrays, at = {}, 8 + size
        for name, kind, n in json.loads(data[8:at].tobytes()):
            length = n * np.dtype(kind).itemsize
            arrays[name] = data[at : at + length].view(kind)
            at += length + -length % 8
        return cls(arrays)

    def look_up(self, words: list[str]) -> np.ndarray:
        """Each word's number, or -1."""
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        lengths = np.array([len(d) for d in data], np.int64)
        letters = np.frombuffer(b"".join(data), np.uint8)
        begin = np.cumsum(lengths) - lengths
        state, number = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        alive = np.ones(len(words), bool)
        for step in range(int(lengths.max(initial=0))):
            walking = np.flatnonzero(alive & (lengths > step))
            if not len(walking):
                break
            wanted = (state[walking] << 8) | letters[begin[walking] + step]
            at = np.searchsorted(self.arcs, wanted)
            hit = at < len(self.arcs)
            hit[hit] = self.arcs[at[hit]] == wanted[hit]
            alive[walking[~hit]] = False
            on, at = walking[hit], at[hit]
            state[on], number[on] = self.targets[at], number[on] + self.adds[at]
        found = alive & (lengths > 0)
        found[found] = self.final[state[found]]
        return np.where(found, number, -1)

    def ids_of(self, number: int) -> list[int]:
        return self.ids[self.starts[number] : self.starts[number + 1]].tolist()


class Encoder:
    """Ids of texts: new pieces go through the automaton, and are merged if it does not hold them."""

    def __init__(self, rules: Rules, lexicon: Lexicon):
        self.rules, self.lexicon = rules, lexicon
        # Per piece its ids; per chunk its ids packed, or " id id id" and " token token" as bytes.
        self.pieces: Recent[list[int]] = Recent(CACHED_CHUNKS)
        self.packed: Recent[tuple[bytes, ...]] = Recent(CACHED_CHUNKS)
        self.written: Recent[tuple[bytes, ...]] = Recent(CACHED_CHUNKS)
        self.forms = {i: (f" {i}".encode(), f" {t}".encode()) for i, t in rules.names.items()}

    def _pack(self, ids: list[int]) -> tuple[bytes, ...]:
        return (np.array(ids, "<i4").tobytes(),)

    def _write(self, ids: list[int]) -> tuple[bytes, ...]:
        both = [self.forms[i] for i in ids]
        return b"".join([b[0] for b in both]), b"".join([b[1] for b in both])

    def _encoded(self, chunks: list[str]) -> Iterator[list[int]]:
        split = [self.rules.split(c) for c in chunks]
        wanted = list(dict.fromkeys(p for s in split for p in s if isinstance(p, str)))
        found, new = self.pieces.values(wanted)
        pieces = [wanted[i] for i in new]
        numbers = self.lexicon.look_up(pieces).tolist()
        merged = iter(self.rules.merged([p for p, n in zip(pieces, numbers, strict=True) if n < 0]))
        ids = [self.lexicon.ids_of(n) if n >= 0 else next(merged) for n in numbers]
        self.pieces.learn(pieces, ids, LEXICON_LENGTH)
        known = dict(zip(wanted, found, strict=True))
        known.update(zip(pieces, ids, strict=True))
        for parts in split:
            yield [i for p in parts for i in (known[p] if isinstance(p, str) else (p,))]

    def _replaced(self, texts: pa.Array, known: Recent[tuple[bytes, ...]], form) -> list[list[memoryview]]:
        chunks = Chunks(texts)
        found, new = known.values(chunks.distinct)
        strings = [chunks.distinct[i] for i in new]
        made = list(map(form, self._encoded(strings)))
        known.learn(strings, made, LEXICON_LENGTH)
        for i, x in zip(new, made, strict=True):
            found[i] = x
        columns = zip(*found, strict=True) if found else [[], []]
        return [chunks.joined(list(column)) for column in columns]

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        return [np.frombuffer(x, "<i4") for x in self._replaced(texts, self.packed, self._pack)[0]]

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by a space, as the library does for a file without a decoder."""
        return " ".join(map(self.rules.names.__getitem__, ids))

    def digests(self, texts: pa.Array) -> tuple[list[int], list[str], list[str]]:
        """Per text: the number of ids, and sha256 of the ids and of the decoded text."""
        numbers, tokens = self._replaced(texts, self.written, self._write)
        sizes = [bytes(x).count(b" ") for x in numbers]
        return (sizes, [hashlib.sha256(x[1:]).hexdigest() for x in numbers],
                [hashlib.sha256(x[1:]).hexdigest() for x in tokens])


def frequent_pieces(docs: DataFrame, limit: int = LEXICON_WORDS) -> list[str]:
    """The most frequent runs of letters of all texts in lower case, by count and then by the run."""
    low = F.lower(F.coalesce("text", F.lit("")))
    words = docs.select(F.explode(F.split(low, r"[^\p{L}]+")).alias("w"))
    short = words.where((F.length("w") > 0) & (F.length("w") <= LEXICON_LENGTH))
    counted = short.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    top = counted.orderBy(F.desc("n"), "w").limit(limit).select("w").toArrow()
    return top.column("w").to_pylist()


def compile_lexicon(docs: DataFrame, rules: Rules, limit: int = LEXICON_WORDS) -> Lexicon:
    """An automaton of at most `limit` runs; those that the tokenizer would split are left out."""
    chosen = [w for w in frequent_pieces(docs, limit) if rules.split(w) == [w]]
    return Lexicon.compiled(dict(zip(chosen, rules.merged(chosen), strict=True)))


def _encoder(rules_text: str, file_name: str) -> Encoder:
    """A task's encoder, over the executor's copy of the automaton's file.

    Reading the rules takes a tenth of a second, so a worker does not hold them between tasks.
    """
    return Encoder(Rules(rules_text), Lexicon.mapped(SparkFiles.get(file_name)))


def sent_encoder(docs: DataFrame, tokenizer_file: str, limit: int = LEXICON_WORDS):
    """A function for tasks that gives their encoder.

    The automaton (bounded by `limit`) is written to the shared folder, and Spark brings the file
    to each executor, where workers map it. The rules (about 2 MB) are broadcast.
    """
    with open(tokenizer_file, encoding="utf-8") as f:
        rules_text = f.read()
    context = docs.sparkSession.sparkContext
    data = compile_lexicon(docs, Rules(rules_text), limit).to_bytes()
    folder = work_folder(docs.sparkSession, "lexicon")
    # Spark tells files by their names alone, so each lexicon has its own.
    name = f"{folder.rpartition('/')[2]}.bin"
    path = f"{folder}/{name}"
    write_bytes(docs.sparkSession, path, data)
    context.addFile(path)
    rules = context.broadcast(rules_text)
    return lambda: _encoder(rules.value, name)


def encoded(docs: DataFrame, tokenizer_file: str, limit: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, ids (array of int) and the decoded text of each row; a NULL text counts as empty."""
    encoder = sent_encoder(docs, tokenizer_file, limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder()
        for batch in slices(batches, SLICE_BYTES):
            ids = coder.ids(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())),
                 pa.array([coder.decode(i) for i in map(np.ndarray.tolist, ids)], pa.string())],
                ["doc_id", "ids", "decoded"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(lean(run), "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, tokenizer_file: str, limit: int = LEXICON_WORDS,
            also: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row, without moving the ids.

    The long columns named in `also` come along.
    """
    encoder = sent_encoder(docs, tokenizer_file, limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder()
        for batch in slices(batches, SLICE_BYTES):
            sums = coder.digests(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sums[0], pa.int64()),
                 pa.array(sums[1], pa.string()), pa.array(sums[2], pa.string()),
                 *[batch.column(c) for c in also]],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *also],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *also)
    more = "".join(f", {c} long" for c in also)
    return rows.mapInArrow(
        lean(run), f"doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string{more}"
    )
