"""SentencePiece encoding and decoding as a shortest path through a weighted finite-state transducer.

The transducer of a model file is compiled from its normaliser, its pieces and its byte fallback. An
input composed with it is a lattice: states are the places between characters, and for a model of
merges also the last piece, arcs are pieces that match there. Weights are of the tropical semiring:
along a path they add up, and among paths the least counts.

* Unigram models: an arc weighs minus the score of its piece. The path is found by states of places.
* BPE models: the merges decide, not a sum of scores. A segmentation is the one of the merges if and
  only if every two neighbouring pieces come out of merging the two alone, so an arc weighs nothing
  where the piece before allows it and infinity elsewhere, and exactly one path is finite.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlane.llm.common import give_back, kept

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: What the score of an unknown character lies below the least score of a piece.
UNKNOWN_PENALTY = 10.0
#: Different words, and pairs of pieces, that a worker remembers.
CHUNKS_KEPT, PAIRS_KEPT = 300_000, 200_000


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol buffer message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = number(at)
        if tag & 7 == 0:
            value, at = number(at)
        elif tag & 7 == 2:
            size, at = number(at)
            value, at = data[at : at + size], at + size
        else:
            size = {1: 8, 5: 4}[tag & 7]
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class Model:
    """What a model file says: pieces, kind, normaliser."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        kind, self.byte_fallback = UNIGRAM, False
        self.dummy_prefix, self.fold_spaces, self.charsmap = True, True, b""
        for field, value in _fields(data):
            if field == 1:
                part = dict(_fields(value))
                score = struct.unpack("<f", part[2])[0] if 2 in part else 0.0
                self.pieces.append((part.get(1, b"").decode(), score, part.get(3, NORMAL)))
            elif field == 2:
                part = dict(_fields(value))
                kind, self.byte_fallback = part.get(3, UNIGRAM), bool(part.get(35, 0))
            elif field == 3:
                part = dict(_fields(value))
                self.charsmap = part.get(2, b"")
                self.dummy_prefix, self.fold_spaces = bool(part.get(3, 1)), bool(part.get(4, 1))
                if not part.get(5, 1):
                    raise ValueError("models that do not escape white space are not supported")
        if kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        if self.charsmap:
            raise ValueError("models with a character map are not supported; normalise the texts beforehand")
        self.bpe = kind == BPE


class Transducer:
    """The compiled model. States of its prefix tree are held by the strings that lead to them."""

    def __init__(self, data: bytes):
        model = self.model = Model(data)
        self.ids, self.scores, self.bytes = {}, {}, {}
        self.unknown = 0
        user = []
        for i, (piece, score, kind) in enumerate(model.pieces):
            if kind in (NORMAL, USER_DEFINED, UNUSED):
                self.ids[piece], self.scores[piece] = i, score
            if kind == USER_DEFINED:
                user.append(piece)
            elif kind == BYTE:
                self.bytes[int(piece[3:5], 16)] = i
            elif kind == UNKNOWN:
                self.unknown = i
        if any(kind == UNUSED for _, _, kind in model.pieces):
            raise ValueError("unused pieces are not supported")
        self.user = re.compile("|".join(map(re.escape, sorted(user, key=len, reverse=True)))) if user else None
        normal = [p for p, (_, _, kind) in zip([x[0] for x in model.pieces], model.pieces) if kind == NORMAL]
        self.penalty = min((self.scores[p] for p in normal), default=0.0) - UNKNOWN_PENALTY
        self.chunks: dict[str, bytes] = {}
        self.apart: dict[int, bool] = {}
        # a piece whose own merges end in other pieces is on no path of merges
        self.halves = {p: h for p in self.ids if len(p) > 1 and (h := self._last_merge(p))} if model.bpe else {}
        # arcs by number: the pieces, and behind them single characters that are none
        self.texts = [p for p, _, _ in model.pieces]
        self.numbers = {p: i for p, i in self.ids.items() if len(p) == 1 or not model.bpe or p in self.halves}
        self.tree: dict = {}
        for piece in [*self.numbers, *{c for p in self.ids for c in p}]:
            node = self.tree
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = self._number(piece)
        self.joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        # pieces never reach over the start of a word, if none holds a space behind another character
        self.by_word = all(SPACE not in p.lstrip(SPACE) for p in self.ids) and not user
        alone = all("\n" not in p or len(p) == 1 for p in self.ids)
        self.chunk = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+" if alone else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.text_of = [self._decoded(p, kind) for p, _, kind in model.pieces]

    @staticmethod
    def _decoded(piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        return " ⁇ ".encode() if kind == UNKNOWN else piece.replace(SPACE, " ").encode()

    def normalise(self, text: str) -> str:
        """The text as the pieces have it: spaces as marks, and what the model says of spaces at its ends."""
        if self.model.fold_spaces:
            text = re.sub(" +", " ", text).strip(" ")
        if text and self.model.dummy_prefix:
            text = " " + text
        return text.replace(" ", SPACE)

    def _number(self, piece: str) -> int:
        number = self.numbers.get(piece)
        if number is None:
            number = self.numbers[piece] = len(self.texts)
            self.texts.append(piece)
        return number

    def _last_merge(self, text: str) -> tuple[str, str] | None:
        """The two pieces that merge last when a text is merged by itself; None if more than one piece is left."""
        parts, queue, last = list(text), [], None
        after, before = list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(text) and (score := self.scores.get(parts[i] + parts[after[i]])) is not None:
                heappush(queue, (-score, i, parts[i], parts[after[i]]))

        for i in range(len(text) - 1):
            offer(i)
        while queue:
            _, i, a, b = heappop(queue)
            j = after[i]
            if parts[i] != a or j >= len(text) or parts[j] != b:
                continue  # one of the two has merged with another piece meanwhile
            parts[i], parts[j], after[i], last = a + b, "", after[j], (a, b)
            if after[i] < len(text):
                before[after[i]] = i
            offer(i)
            offer(before[i])
        return last if parts[0] == text else None

    def allows(self, left: int, right: int) -> bool:
        """Whether two neighbouring pieces stay apart when their text is merged.

        Looks from the border back in time: where the pieces on both sides of it would have merged
        before the merge that made one of them larger, they do not stay apart. Of equal scores the
        left one merges first.
        """
        a, b, before, equal_too, known = self.texts[left], self.texts[right], float("inf"), True, True
        while True:
            rank = self.scores.get(a + b)
            if rank is not None and (-rank < before or equal_too and -rank == before):
                known = False
                break
            made_a = -self.scores[a] if a in self.halves else float("-inf")
            made_b = -self.scores[b] if b in self.halves else float("-inf")
            if a not in self.halves and b not in self.halves:
                break
            if made_a > made_b:
                before, equal_too, a = made_a, False, self.halves[a][1]
            else:
                before, equal_too, b = made_b, True, self.halves[b][0]
        if len(self.apart) >= PAIRS_KEPT:
            self.apart.clear()
        self.apart[left << 32 | right] = known
        return known

    def _matches(self, text: str, start: int) -> list[tuple[int, int]]:
        """Arcs from a place and where they lead, the longest last."""
        node, end, n, found = self.tree.get(text[start]), start + 1, len(text), []
        if node is None:  # no piece has this character
            return [(self._number(text[start]), end)]
        while True:
            if "" in node:
                found.append((node[""], end))
            if end == n or (node := node.get(text[end])) is None:
                return found
            end += 1

    def _path_of_merges(self, text: str) -> list[int]:
        """The one finite path, searched with the longest arcs first.

        Only one finite path leads to a place, so a place from which the end was not reached is given
        up for good: the search takes no more steps than there are arcs.
        """
        n, known, allows = len(text), self.apart.get, self.allows
        dead, path, ways, left, start = bytearray(n + 1), [], [], -1, 0
        arcs = self._matches(text, 0) if n else []
        while start < n:
            while arcs:
                piece, end = arcs.pop()
                if dead[end]:
                    continue
                free = left < 0 or known(left << 32 | piece)
                if free is None:
                    free = allows(left, piece)
                if free:
                    ways.append((start, left, arcs))
                    path.append(piece)
                    start, left = end, piece
                    arcs = self._matches(text, end) if end < n else []
                    break
            else:
                dead[start] = 1
                start, left, arcs = ways.pop()
                path.pop()
        return path

    def _path_of_scores(self, text: str) -> list[int]:
        """The path of least weight, where a weight is minus a score."""
        n, known = len(text), len(self.model.pieces)
        best, last, since = [0.0] + [float("inf")] * n, [-1] * (n + 1), [0] * (n + 1)
        for start in range(n):
            node, end = self.tree.get(text[start], {"": self._number(text[start])}), start + 1
            while True:
                piece = node.get("")
                if piece is not None:
                    weight = best[start] - (self.model.pieces[piece][1] if piece < known else self.penalty)
                    if weight < best[end]:
                        best[end], last[end], since[end] = weight, piece, start
                if end == n or (node := node.get(text[end])) is None:
                    break
                end += 1
        return self._back(last, since)

    @staticmethod
    def _back(last: list[int], since: list[int]) -> list[int]:
        path, end = [], len(last) - 1
        while end:
            path.append(last[end])
            end = since[end]
        return path[::-1]

    def _outputs(self, path: list[int]) -> Iterator[int]:
        """The ids along a path; unknown characters become their bytes, or one unknown piece for a run of them."""
        pieces, before = len(self.model.pieces), 0
        for piece in path:
            if piece < pieces:
                yield piece
            elif self.model.byte_fallback:
                yield from (self.bytes[b] for b in self.texts[piece].encode())
            elif before < pieces:
                yield self.unknown
            before = piece

    def _encode_part(self, text: str) -> list[int]:
        return list(self._outputs((self._path_of_merges if self.model.bpe else self._path_of_scores)(text)))

    def _encode_chunk(self, chunk: str) -> bytes:
        """The ids of a chunk as bytes. Where no piece has two characters side by side, the lattice falls
        apart between them, and each different part is composed once."""
        if len(self.chunks) >= CHUNKS_KEPT:
            self.chunks.clear()
        cuts = [0, *(i for i in range(1, len(chunk)) if chunk[i - 1 : i + 1] not in self.joined), len(chunk)]
        parts = []
        for a, b in zip(cuts, cuts[1:]):
            part = chunk[a:b]
            found = self.chunks.get(part)
            if found is None:
                found = array("i", self._encode_part(part)).tobytes()
                if len(part) <= 64:
                    self.chunks[part] = found
            parts.append(found)
        ids = b"".join(parts)
        if len(chunk) <= 64:
            self.chunks[chunk] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """The ids of a text."""
        return self.encode_array(text).tolist()

    def encode_array(self, text: str) -> np.ndarray:
        text = self.normalise(text)
        if not self.by_word:
            return np.array(self._with_user_pieces(text), np.int32)
        known, ids = self.chunks.get, []
        for chunk in self.chunk.findall(text):
            ids.append(known(chunk) or self._encode_chunk(chunk))
        return np.frombuffer(b"".join(ids), np.int32)

    def _with_user_pieces(self, text: str) -> list[int]:
        """User-defined pieces are cut out first, as no merge and no other path may touch them."""
        ids, at = [], 0
        for match in self.user.finditer(text) if self.user else ():
            ids += self._encode_part(text[at : match.start()]) + [self.ids[match.group()]]
            at = match.end()
        return ids + self._encode_part(text[at:])

    def decode(self, ids: list[int]) -> str:
        """The text of ids, with the space that stands before the first word taken off again."""
        data = b"".join(map(self.text_of.__getitem__, ids))
        if self.model.dummy_prefix and data.startswith(b" "):
            data = data[1:]
        return data.decode(errors="replace")


def model_bytes(model_file: str) -> bytes:
    """A model file of fixed size, read on the driver and sent to the executors with the function that uses it."""
    with open(model_file, "rb") as file:
        return file.read()


def encode_documents(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_ids, ids, and on demand ``decoded``, the text of the ids.

    Null and empty texts have no ids. Every text is encoded whole and by itself, so null keys, repeated
    rows and ties are rows like any other; other columns are ignored; an empty table gives an empty
    result. Nothing is shuffled.
    """
    data = model_bytes(model_file)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = kept(("transducer", hash(data)), lambda: Transducer(data))
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                ids = [transducer.encode_array(t or "") for t in part.column(1).to_pylist()]
                sizes = np.array([len(i) for i in ids], np.int64)
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                columns = [part.column(0), pa.array(sizes), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids)))]
                if decoded:
                    columns.append(pa.array([transducer.decode(i.tolist()) for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_ids", "ids", "decoded"][: len(columns)])
        give_back()

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        encode, "doc_id long, n_ids long, ids array<int>" + ", decoded string" * decoded)


def decode_documents(encoded: DataFrame, model_file: str) -> DataFrame:
    """Adds ``decoded``, the text of the column ids; null ids give null."""
    data = model_bytes(model_file)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = kept(("transducer", hash(data)), lambda: Transducer(data))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = part.column(part.schema.get_field_index("ids")).to_pylist()
                decoded = pa.array([None if i is None else transducer.decode(i) for i in ids], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=[*part.schema.names, "decoded"])

    return encoded.mapInArrow(decode, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))
