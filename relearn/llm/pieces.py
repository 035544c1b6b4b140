"""Operator 6: piece encoding and decoding, unigram Viterbi over a double-array trie.

The vocabulary file lists pieces in merge order, not with probabilities, so a piece of rank r gets the log score of
Zipf's law, -ln(r H): the best segmentation is the most likely one under these scores.  Spaces become the marker
U+2581, one marker is put before the text.  A character without a piece (the marker itself included, when it stands
in a text) is encoded as its UTF-8 bytes.  Decoding turns markers into spaces and byte runs into characters, and drops
the first marker: it restores every text exactly.

No piece of the usual vocabularies goes on from a letter to a marker or holds a line break, so the best segmentation
of a text is that of its words; words are segmented once and kept in a bounded table.  A vocabulary with such pieces
is segmented text by text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "▁"
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Words kept per task, and the longest one kept (characters); unknown characters cost this more than the rarest piece.
KEPT_WORDS, KEPT_CHARS, UNKNOWN_COST = 1 << 18, 64, 10.0
_LONE_MARK = "\udc81"   # stands for a marker of the text while spaces become markers; no text and no piece holds a lone surrogate

_LONE_BYTES = _LONE_MARK.encode("utf-8", "surrogatepass")


@dataclass
class Trie:
    """Double array: the child of node n by byte b is t = base[n] + b + 1 if check[t] = n; value is a piece or -1."""
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray


def build_trie(keys: dict[bytes, int]) -> Trie:
    children: list[dict[int, int]] = [{}]
    values = [-1]
    for key, piece in keys.items():
        node = 0
        for b in key:
            if b not in children[node]:
                children[node][b] = len(children)
                children.append({})
                values.append(-1)
            node = children[node][b]
        values[node] = piece
    size = 2 * len(children) + 1024
    base, check, value = [0] * size, [-1] * size, [-1] * size
    used = bytearray(size)
    used[0] = 1
    free, top, todo = 1, 0, [(0, 0)]
    while todo:
        node, slot = todo.pop()
        value[slot] = values[node]
        if not children[node]:
            continue
        codes = sorted(b + 1 for b in children[node])
        while used[free]:
            free += 1
        at, tries = max(free - codes[0], 0), 0
        while True:
            tries += 1
            if tries > 64:                # no gap found soon: behind all
                at = max(top + 1 - codes[0], at)
            if at + 257 >= size:
                more = size
                base += [0] * more
                check += [-1] * more
                value += [-1] * more
                used += bytearray(more)
                size += more
            if not any(used[at + c] for c in codes):
                break
            at += 1
        base[slot] = at
        top = max(top, at + codes[-1])
        for b, child in children[node].items():
            t = at + b + 1
            used[t] = 1
            check[t] = slot
            todo.append((child, t))
    last = max(t for t in range(size) if used[t]) + 258
    as_int = lambda x: np.array((x + [-1] * 258)[:last], np.int32)
    return Trie(as_int(base), as_int(check), as_int(value))


@dataclass
class Vocabulary:
    trie: Trie
    score: np.ndarray         # log score by piece id
    bytes_of: list[bytes]     # what each id stands for, marker as space
    byte_id: list[int]        # id of each byte
    by_words: bool            # whether words can be segmented one by one


def load(path: str = VOCABULARY) -> Vocabulary:
    """The vocabulary of a SentencePiece model file (read on the driver; some tens of thousands of pieces)."""
    import sentencepiece
    file = sentencepiece.SentencePieceProcessor(model_file=path)
    n = file.get_piece_size()
    byte_id, bytes_of, normal = [-1] * 256, [b""] * n, []
    for i in range(n):
        piece = file.id_to_piece(i)
        if file.is_byte(i):
            byte_id[int(piece[1:-1], 16)] = i
            bytes_of[i] = bytes([int(piece[1:-1], 16)])
        elif not (file.is_control(i) or file.is_unknown(i) or file.is_unused(i)):
            normal.append(i)
            bytes_of[i] = piece.replace(MARK, " ").encode()
    if min(byte_id) < 0:
        raise ValueError("the vocabulary has no piece for some bytes")
    rank = np.arange(1, len(normal) + 1)
    score = np.full(n, -np.inf)
    score[normal] = -np.log(rank * (1 / rank).sum())
    texts = {file.id_to_piece(i): i for i in normal}
    by_words = not any(MARK in t.lstrip(MARK) or "\n" in t for t in texts)
    return Vocabulary(build_trie({t.encode(): i for t, i in texts.items()}), score, bytes_of, byte_id, by_words)


class Encoder:
    """Segments texts; made once per task."""

    def __init__(self, v: Vocabulary):
        self.base, self.check, self.value = v.trie.base.tolist(), v.trie.check.tolist(), v.trie.value.tolist()
        self.score, self.byte_id = v.score.tolist(), v.byte_id
        self.unknown = float(v.score[np.isfinite(v.score)].min()) - UNKNOWN_COST
        self.split = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+").findall if v.by_words else lambda text: [text]
        self.known: dict[str, tuple[int, ...]] = {}

    def viterbi(self, text: str) -> tuple[int, ...]:
        """Piece ids of the segmentation with the largest sum of scores; of equal ones that found first."""
        data = text.encode("utf-8", "surrogatepass")
        n = len(data)
        base, check, value, score = self.base, self.check, self.value, self.score
        best, back = [None] * (n + 1), [None] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            so_far = best[i]
            if so_far is None:
                continue
            lead = data[i]
            char = i + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            node, j, alone = 0, i, False
            while j < n:
                t = base[node] + data[j] + 1
                if check[t] != node:
                    break
                node = t
                j += 1
                piece = value[t]
                if piece >= 0:
                    alone = alone or j == char
                    s = so_far + score[piece]
                    if best[j] is None or s > best[j]:
                        best[j], back[j] = s, (i, piece)
            if not alone:
                s = so_far + self.unknown
                if best[char] is None or s > best[char]:
                    best[char], back[char] = s, (i, -1)
        out, j = [], n
        while j:
            i, piece = back[j]
            if piece >= 0:
                out.append(piece)
            else:
                raw = data[i:j] if data[i:j] != _LONE_BYTES else MARK.encode()
                out.extend(self.byte_id[b] for b in reversed(raw))
            j = i
        return tuple(reversed(out))

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        known = self.known
        for word in self.split(MARK + text.replace(MARK, _LONE_MARK).replace(" ", MARK)):
            ids = known.get(word)
            if ids is None:
                ids = self.viterbi(word)
                if len(word) <= KEPT_CHARS:
                    if len(known) >= KEPT_WORDS:
                        known.clear()
                    known[word] = ids
            out.extend(ids)
        return out


class Decoder:
    """Texts of piece ids; made once per task."""

    def __init__(self, bytes_of: list[bytes]):
        self.data = np.frombuffer(b"".join(bytes_of), np.uint8)
        self.length = np.array([len(b) for b in bytes_of])
        self.first = np.cumsum(self.length) - self.length

    def decode(self, ids: np.ndarray) -> str:
        ids = ids[(ids >= 0) & (ids < len(self.length))]
        length = self.length[ids]
        ends = np.cumsum(length)
        at = np.repeat(self.first[ids] - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)
        raw = self.data[at].tobytes()
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def _shared(spark: SparkSession, v: Vocabulary):
    """The vocabulary's plain parts as a broadcast: about a megabyte, bounded by the file."""
    return spark.sparkContext.broadcast((v.trie.base, v.trie.check, v.trie.value, v.score, v.bytes_of, v.byte_id, v.by_words))


def _vocabulary(parts) -> Vocabulary:
    return Vocabulary(Trie(*parts[:3]), *parts[3:])


def encode(docs: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``ids``, ``n_pieces``, ``n_byte_pieces`` for every row of ``docs``.

    Null and empty texts have no pieces.  Rows are encoded one by one, repeated ones alike; a vocabulary is whole, so
    every text has an encoding.  Other columns are left out, an empty table gives no rows.
    """
    shared = _shared(docs.sparkSession, vocabulary)
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]):
        v = _vocabulary(shared.value)
        encoder = Encoder(v)
        is_byte = np.zeros(len(v.score), bool)
        is_byte[v.byte_id] = True
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for a in range(0, len(texts), 500):            # pieces of some documents at a time
                ids = [np.array(encoder.encode(t.as_py()), np.int32) for t in texts.slice(a, 500)]
                offsets = np.r_[0, np.cumsum([len(i) for i in ids])]
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                part = batch.slice(a, 500)
                n_bytes = np.diff(np.r_[0, np.cumsum(is_byte[flat])][offsets])
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(keep))]
                    + [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)), pa.array(np.diff(offsets).astype(np.int64)), pa.array(n_bytes.astype(np.int64))],
                    names=[*[f"c{i}" for i in range(len(keep))], "ids", "n_pieces", "n_byte_pieces"])
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kept}, ids array<int>, n_pieces long, n_byte_pieces long").toDF(*keep, "ids", "n_pieces", "n_byte_pieces")


def decode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``rows`` with ``decoded``, the text of ``ids``; null or empty ids give an empty text, other ids than pieces nothing."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary.bytes_of)
    names, place = rows.columns, rows.columns.index("ids")
    rows = rows.toDF(*[f"c{i}" for i in range(len(names))])

    def run(batches: Iterator[pa.RecordBatch]):
        decoder = Decoder(shared.value)
        for batch in batches:
            ids = batch.column(place)
            flat, n = ids.flatten().fill_null(-1).to_numpy(zero_copy_only=False), ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(n)
            texts = [decoder.decode(flat[a:b]) for a, b in zip(ends - n, ends)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{kept}, decoded string").toDF(*names, "decoded")
