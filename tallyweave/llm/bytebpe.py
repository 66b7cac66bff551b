"""Byte-level BPE: encoding with the tokenizers library over Arrow batches, offsets, and decoding by the byte table the other way round."""

from __future__ import annotations

import base64
import hashlib
import itertools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm.common import pieces, process_cache, table, text_map

#: Distinct pieces whose ids a worker remembers; then it starts anew. Only speed depends on it.
PIECE_CACHE = 500_000


def byte_table() -> list[str]:
    """The character that stands for each byte: printable Latin-1 characters stand for themselves, the rest for U+0100 onwards."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in kept else next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file with a base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def basic_plane(pattern: str):
    """findall for texts without characters above U+FFFF: the standard matcher, with the classes written out as ranges, is three times as fast. None if the pattern has other classes than these."""
    import re

    import regex

    every = "".join(chr(x) for x in range(0x10000) if not 0xD800 <= x < 0xE000)
    classes = {c: "".join(f"\\u{ord(m[0][0]):04x}-\\u{ord(m[0][-1]):04x}" for m in regex.finditer(f"{c}+", every)) for c in (r"\p{L}", r"\p{N}", r"\s")}
    out, inside, at = "", False, 0
    while at < len(pattern):
        if found := next((c for c in classes if pattern.startswith(c, at)), ""):
            out += classes[found] if inside else f"[{classes[found]}]"
        elif pattern.startswith(r"\S", at) and not inside:
            found, out = r"\S", out + f"[^{classes[r'\s']}]"
        elif pattern[at] == "\\":
            return None
        else:
            found = pattern[at]
            inside = found == "[" or inside and found != "]"
            out += found
        at += len(found)
    return re.compile(out).findall


class Codec:
    """Ids of the pieces of a text, as plain rank merging gives them.

    Rank files name no merges. A pair may merge whenever its concatenation has a rank, so every split
    of a token into two tokens becomes a merge, in the order of ranks; a piece that is a token itself
    is taken whole.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex
        from tokenizers import Tokenizer, models

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        chars = byte_table()
        shown = {token: "".join(map(chars.__getitem__, token)) for token in ranks}
        merges = [(shown[token[:i]], shown[token[i:]]) for token in sorted(ranks, key=ranks.get) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
        self.model = Tokenizer(models.BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True, cache_capacity=0)).model
        self.find_any = regex.compile(pattern).findall
        self.find_basic = basic_plane(pattern) or self.find_any
        self.chars = {b: c for b, c in enumerate(chars)}
        self.back = {ord(c): b for b, c in enumerate(chars)}
        size = max(ranks.values(), default=-1) + 1
        #: The characters that stand for the bytes of each id.
        self.shown = [""] * size
        for token, rank in ranks.items():
            self.shown[rank] = shown[token]
        self.lengths = np.fromiter(map(len, self.shown), np.int64, size)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.first, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def learn(self, new: list[str]) -> None:
        shown = [piece.encode().decode("latin-1").translate(self.chars) for piece in new]
        tokenize = self.model.tokenize
        ids = [[token.id for token in tokenize(chars)] for chars in shown]
        k, count = len(self.known), np.fromiter(map(len, ids), np.int64, len(ids))
        while k + len(ids) > len(self.first):
            self.first, self.count = np.resize(self.first, 2 * len(self.first)), np.resize(self.count, 2 * len(self.count))
        total = int(count.sum())
        while self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.used : self.used + total] = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, total)
        self.first[k : k + len(ids)], self.count[k : k + len(ids)] = self.used + np.cumsum(count) - count, count
        self.used += total
        self.known.update(zip(new, range(k, k + len(ids)), strict=True))

    def pieces(self, text: str) -> tuple[list[str], np.ndarray]:
        """The matches of the pattern in a text, and the number of each among the known pieces."""
        if len(self.known) > PIECE_CACHE:
            self.forget()
        found = (self.find_basic if len(text.encode("utf-16-le")) == 2 * len(text) else self.find_any)(text)
        if new := [x for x in dict.fromkeys(found) if x not in self.known]:
            self.learn(new)
        return found, np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))

    def encode(self, text: str) -> np.ndarray:
        """The ids (uint32) of a text; each match of the pattern by itself."""
        return self.ids(self.pieces(text)[1])

    def ids(self, index: np.ndarray) -> np.ndarray:
        count = self.count[index]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.first[index] - (ends - count), count) + np.arange(total)]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word (no ASCII spaces in it) after a space; each word by itself, whatever stands beside it."""
        # A piece can reach over words only through other spaces than ASCII ones; str.split knows all of them.
        odd = {w for w in words if w.split() != [w]}
        out = {w: self.encode(" " + w).tolist() for w in odd}
        plain = [w for w in words if w not in odd]
        if plain:
            found, index = self.pieces(" " + " ".join(plain))
            ids, count = self.ids(index).tolist(), np.cumsum(self.count[index])
            cuts = [0 if i == 0 else int(count[i - 1]) for i, x in enumerate(found) if x[0] == " "]
            out |= {w: ids[a:b] for w, a, b in zip(plain, cuts, [*cuts[1:], len(ids)], strict=True)}
        return [out[w] for w in words]

    def spell(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """What encode_words gives for words in UTF-8: the ids of all words one after another, and how many each word has."""
        text = b" ".join(words).decode()
        plain = text.split(" ")
        if text.split() != plain:
            ids = self.encode_words(plain) if words else []
            count = np.fromiter(map(len, ids), np.int64, len(ids))
            return np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(count.sum())), count
        found, index = self.pieces(" " + text)
        first = np.fromiter(map(str.startswith, found, itertools.repeat(" ")), bool, len(found))
        return self.ids(index), np.add.reduceat(self.count[index], np.flatnonzero(first))

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and character after the last of each id. A character split over ids belongs to each of them."""
        raw = np.frombuffer(text.encode(), np.uint8)
        char = np.cumsum((raw & 0xC0) != 0x80) - 1
        end = np.cumsum(self.lengths[ids])
        if len(raw) == 0 or len(ids) == 0:
            return np.zeros(0, np.int32), np.zeros(0, np.int32)
        return char[end - self.lengths[ids]].astype(np.int32), (char[end - 1] + 1).astype(np.int32)

    def decode(self, ids) -> bytes:
        """The bytes of the ids: the characters of each id, through the byte table the other way round. An id without a token raises IndexError."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.shown) or not self.lengths[ids].all()):
            raise IndexError("an id has no token")
        return "".join(map(self.shown.__getitem__, ids.tolist())).translate(self.back).encode("latin-1")

    def split_characters(self, start: np.ndarray, end: np.ndarray) -> int:
        """How many characters are split over several ids, by the ids' offsets: those that an id shares with the one before."""
        return len(np.unique(start[1:][start[1:] < end[:-1]]))


def codec(ranks: dict[bytes, int], pattern: str, name: str) -> Codec:
    """One codec for each vocabulary and worker process."""
    cache = process_cache("bpe")
    if name not in cache:
        cache[name] = Codec(ranks, pattern)
    return cache[name]


def _shared(spark: SparkSession, path: str, pattern: str):
    """The vocabulary as a broadcast: its size is that of one rank file, whatever the corpus."""
    with open(path, "rb") as file:
        name = hashlib.sha256(file.read() + pattern.encode()).hexdigest()
    return spark.sparkContext.broadcast(read_ranks(path)), pattern, name


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = True) -> DataFrame:
    """id_col, ids array<int>, char_start and char_end array<int> (empty if not offsets) of every whole text.

    Null and empty texts have no ids. Each row of df gives one row, also null and repeated ids. Other columns are left out.
    """
    shared, pattern, name = _shared(df.sparkSession, path, pattern)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value, pattern, name)
        for batch in batches:
            ids, start, end = [], [], []
            for text in batch.column(1).to_pylist():
                ids.append(own.encode(text or ""))
                s, e = own.offsets(text or "", ids[-1]) if offsets else (np.zeros(0, np.int32),) * 2
                start.append(s)
                end.append(e)
            lists = [pa.array([x.astype(np.int32) for x in xs], pa.list_(pa.int32())) for xs in (ids, start, end)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], ["id", "ids", "char_start", "char_end"])

    kind = df.schema[id_col].dataType.simpleString()
    out = df.select(F.col(id_col), F.col(text_col)).mapInArrow(lambda it: work(pieces(it, 64)), f"id {kind}, ids array<int>, char_start array<int>, char_end array<int>")
    return out.withColumnRenamed("id", id_col)


def decode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id_col, bytes binary, text string of every list of ids. A character of which only some bytes are there becomes U+FFFD in text, not in bytes.

    Null lists give empty bytes.
    """
    shared, pattern, name = _shared(df.sparkSession, path, pattern)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value, pattern, name)
        for batch in batches:
            raw = [own.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary()), pa.array([x.decode(errors="replace") for x in raw])], ["id", "bytes", "text"])

    kind = df.schema[id_col].dataType.simpleString()
    return text_map(df, [id_col, ids_col], work, f"id {kind}, bytes binary, text string").withColumnRenamed("id", id_col)


def round_trip(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_tokens, ids_sha256, decoded_sha256, offsets_sha256 (first and last character + 1 of each id, little-endian int32), n_split (characters split over ids), same (the decoded bytes are the text's).

    Encoding, offsets and decoding are those of encode and decode, in one pass of which only digests
    leave the worker. Null texts count as empty; each row gives one row, also null and repeated ids; an
    empty table gives none. Other columns are left out.
    """
    shared, pattern, name = _shared(df.sparkSession, path, pattern)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value, pattern, name)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                ids = own.encode(text or "")
                start, end = own.offsets(text or "", ids)
                back = own.decode(ids)
                rows.append((len(ids), sha(ids.astype("<u4").tobytes()), sha(back), sha(np.stack([start, end]).astype("<i4").tobytes()), own.split_characters(start, end), back == (text or "").encode()))
            n, a, b, o, s, same = zip(*rows, strict=True) if rows else [()] * 6
            columns = [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(o, pa.string()), pa.array(s, pa.int32()), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "n_tokens", "ids_sha256", "decoded_sha256", "offsets_sha256", "n_split", "same"])

    kind = df.schema[id_col].dataType.simpleString()
    return text_map(df, [id_col, text_col], work, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, offsets_sha256 string, n_split int, same boolean").withColumnRenamed("id", id_col)


def op1_bytebpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
