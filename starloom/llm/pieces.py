"""SentencePiece encoding and decoding in a stream, with ids committed as soon as they are certain.

The text is read character by character. A lattice path that ends at a character may still be on the
best path of the whole text; its backpointers reach back at most the longest piece. Where all
surviving paths meet in one boundary, everything before it is certain, is committed, and its window
is dropped. Boundaries that no piece can cross, such as the one before a space that follows another
character, are always such points; what stands between two of them is encoded once per task and then looked up.

* Models of kind ``unigram`` are solved by Viterbi: :class:`StreamingViterbi`.
* Models of kind ``bpe`` keep merge ranks for scores. The path of the largest sum is not what such a
  model stands for, so between two certain boundaries the model's own merges apply.

Decoding concatenates the pieces' bytes. Encoding is exact: decoding gives the text back.

Defined results: a null or empty text has no id. Rows that repeat an id are encoded alike.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.text import slices, strings

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
REMEMBERED = 400_000  # segments that a task keeps before it starts anew
SLICE_BYTES = 1 << 18  # of text at once: decoding takes some fifty bytes for each of it


class StreamingViterbi:
    """Best path over pieces with additive scores, a character at a time.

    ``scores`` gives each piece its log probability; a character that is no piece itself costs ``unknown`` and is
    reported as itself. At most the longest piece's number of open positions is kept beyond the last certain boundary.
    """

    def __init__(self, scores: dict[str, float], unknown: float):
        self.scores, self.unknown = scores, unknown
        self.longest = max(map(len, scores), default=1)
        self.text = ""  # characters after the last committed boundary
        self.best = [(0.0, -1)]  # for each boundary: score and where the last piece begins

    def push(self, characters: Iterable[str]) -> Iterator[str]:
        """Takes more characters and gives the pieces that have become certain."""
        for c in characters:
            self.text += c
            end = len(self.text)
            best = (-float("inf"), end - 1)
            for begin in range(max(0, end - self.longest), end):
                piece = self.text[begin:end]
                score = self.scores.get(piece)
                if score is None:
                    if end - begin > 1:
                        continue
                    score = self.unknown
                if (total := self.best[begin][0] + score) > best[0]:
                    best = (total, begin)
            self.best.append(best)
            yield from self._commit()

    def _commit(self) -> Iterator[str]:
        """Commits up to the last boundary that the paths to all open boundaries share."""
        end = len(self.text)
        alive = {end, *range(max(0, end - self.longest + 1), end)}  # a later piece can begin there
        while len(alive) > 1:
            furthest = max(alive)
            alive.remove(furthest)
            if (back := self.best[furthest][1]) >= 0:
                alive.add(back)
        meet = alive.pop()
        if meet > 0:
            yield from self._pieces(meet)
            base = self.best[meet][0]
            self.best = [(s - base, b - meet) for s, b in self.best[meet:]]
            self.best[0] = (0.0, -1)
            self.text = self.text[meet:]

    def _pieces(self, end: int) -> list[str]:
        found = []
        while end > 0:
            begin = self.best[end][1]
            found.append(self.text[begin:end])
            end = begin
        return found[::-1]

    def close(self) -> list[str]:
        """The pieces of what is still open."""
        found = self._pieces(len(self.text))
        self.text, self.best = "", [(0.0, -1)]
        return found


class Pieces:
    """A model's pieces: exact ids of a segment, and bytes of an id."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.vocab_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        self.bytes: list[bytes] = []
        for i, name in enumerate(names):
            if self.model.is_byte(i):
                self.bytes.append(bytes([int(name[3:-1], 16)]))
            else:
                self.bytes.append(b"" if self.model.is_control(i) else name.replace(SPACE, " ").encode())
        usual = [i for i in range(n) if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        crossing = [names[i] for i in usual if SPACE in names[i].lstrip(SPACE)]
        if crossing or any("\n" in names[i] and len(names[i]) > 1 for i in usual):
            raise ValueError(f"pieces reach over a space or a line's end: {crossing[:3]}")
        self.space = self.model.piece_to_id(SPACE)
        scores = {names[i]: self.model.get_score(i) for i in usual}
        self.ids = {names[i]: i for i in usual}
        self.byte_ids = {self.bytes[i][0]: i for i in range(n) if self.model.is_byte(i)}
        # merge ranks are whole numbers, log probabilities hardly ever are
        ranked = all(s == int(s) for s in scores.values())
        self.segment: Callable[[list[str]], list[list[int]]] = self._merged if ranked else self._best
        self.scores, self.unknown = scores, min(scores.values(), default=0.0) - 10

    def _merged(self, segments: list[str]) -> list[list[int]]:
        """Ids of segments by the model's merges. A segment is what follows a space, or begins with a line's end."""
        found = self.model.encode(segments, num_threads=1)
        return [[self.space] if s == "" else ids[1:] if s[0] == "\n" else ids for s, ids in zip(segments, found, strict=True)]

    def _best(self, segments: list[str]) -> list[list[int]]:
        found = []
        for s in segments:
            viterbi = StreamingViterbi(self.scores, self.unknown)
            marked = (s if s[:1] == "\n" else " " + s).replace(" ", SPACE)
            pieces = [*viterbi.push(marked), *viterbi.close()]
            found.append([i for p in pieces for i in ([self.ids[p]] if p in self.ids else [self.byte_ids[b] for b in p.encode()])])
        return found


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


_SEGMENT = re.compile(r" +[^ \n]*|\n[^ \n]*")


def segments(text: str) -> list[str]:
    """The text in segments that are encoded by themselves, the space in front of each left out."""
    if "  " in text or " \n" in text or text[:1] in (" ", "\n") or text[-1:] == " ":
        return [s[1:] if s[0] == " " else s for s in _SEGMENT.findall(" " + text)]
    return text.replace("\n", " \n").split(" ") if text else []


class Encoder:
    """Encodes texts; segments met before are looked up."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.first = np.zeros(1, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and the bounds of each text's."""
        if len(self.number) > REMEMBERED:
            self.forget()
        parts = [segments(t or "") for t in texts]
        new = list({s for p in parts for s in p if s not in self.number})
        if new:
            found = self.pieces.segment(new)
            self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self.ids = np.concatenate([self.ids, np.fromiter((i for f in found for i in f), np.int32, int(sizes.sum()))])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])
        number = self.number
        chosen = np.fromiter((number[s] for p in parts for s in p), np.int64, sum(map(len, parts)))
        sizes = self.first[chosen + 1] - self.first[chosen]
        ends = np.cumsum(sizes)
        at = np.arange(int(sizes.sum())) + np.repeat(self.first[chosen] - ends + sizes, sizes)
        bounds = np.r_[0, ends][np.r_[0, np.cumsum([len(p) for p in parts])]] if parts else np.zeros(1, np.int64)
        return self.ids[at], bounds


class Decoder:
    """Decodes ids by putting their pieces' bytes together."""

    def __init__(self, pieces: Pieces):
        self.sizes = np.array([len(b) for b in pieces.bytes], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(pieces.bytes), np.uint8)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The texts' bytes; the space in front that encoding adds is taken off."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.arange(int(sizes.sum())) + np.repeat(self.first[ids] - ends + sizes, sizes)
        data = self.data[at].tobytes()
        edges = np.r_[0, ends][bounds].tolist()
        texts = [data[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return [t[1:] if t[:1] == b" " else t for t in texts]


def encode(docs: DataFrame, *, id_col="doc_id", text_col="text", model=MODEL, columns=None) -> DataFrame:
    """The id (or the named columns), ``n_pieces``, ``pieces`` (ids) and ``exact``: whether decoding them gives the text."""
    columns = columns or [id_col]

    def each(batches):
        pieces = load(model)
        encoder, decoder = Encoder(pieces), Decoder(pieces)
        for batch in batches:
            carried = [strings(batch[c]) for c in columns]
            for row, part in slices(batch[text_col], SLICE_BYTES):
                texts = part.to_pylist()
                ids, bounds = encoder.encode(texts)
                exact = [a == b.encode() for a, b in zip(decoder.decode(ids, bounds), texts, strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(row, n) for c in carried), pa.array(np.diff(bounds)), lists, pa.array(exact, pa.bool_())],
                    [*columns, "n_pieces", "pieces", "exact"],
                )

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns]
    schema = ", ".join([*fields, "n_pieces long, pieces array<int>, exact boolean"])
    return docs.select(*dict.fromkeys([*columns, text_col])).mapInArrow(each, schema)


def decode(encoded: DataFrame, *, id_col="doc_id", pieces_col="pieces", model=MODEL) -> DataFrame:
    """The id and the ``text`` that a column of ids stands for; a null list gives null."""

    def each(batches):
        decoder = Decoder(load(model))
        for batch in batches:
            lists = strings(batch[pieces_col])
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = np.array([0 if n is None else n for n in pc.list_value_length(lists).to_pylist()], np.int64)
            texts = decoder.decode(ids, np.r_[0, np.cumsum(sizes)])
            found = [t.decode("utf-8", "replace") if ok else None for t, ok in zip(texts, lists.is_valid().to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([strings(batch[id_col]), pa.array(found, pa.string())], [id_col, "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, F.col(pieces_col)).mapInArrow(each, f"`{id_col}` {kind}, text string")
