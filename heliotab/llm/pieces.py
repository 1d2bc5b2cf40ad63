"""SentencePiece encoding and decoding by a streaming Viterbi search over whole texts.

The pieces and their scores come from a given model file; nothing is trained.  A text is encoded
as the sequence of pieces with the largest total score (unigram segmentation), a dummy space in
front, spaces matching the pieces' ``▁``.  A character that is no piece becomes its UTF-8 bytes
as byte pieces, at a cost below every piece's score.  A ``▁`` of the text itself is such a
character, so decoding returns every text exactly.  Of equal totals the one whose last piece is
longer wins.

The search goes over the bytes once and keeps scores for the last ``longest piece`` places only.
All surviving paths pass through a place before a space that follows a non-space, because no piece
has a space behind another character: there, ids are committed.  Inside such a stretch two forms
of the same search run: ``Stream`` for long stretches, which commits whenever the paths of all
places in the window converge, and a form for short ones that searches many distinct stretches at
a time in columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from heliotab.llm.shipping import ship
from heliotab.llm.words import powers, prefix_hash, text_blocks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SHORT = 40  # bytes of a stretch that is searched in columns
BLOCK_TEXT = 1 << 21
TOGETHER = 1 << 15  # stretches that are searched together
_NEVER = -(1 << 62)


class Pieces:
    """The pieces of a model as byte strings, ``▁`` as a space."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.text = [b""] * n
        self.of_byte = np.full(256, -1, np.int64)
        self.ids: dict[bytes, int] = {}
        score = np.zeros(n)
        for i in range(n):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[1:-1], 16)
                self.of_byte[value], self.text[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.text[i] = model.id_to_piece(i).replace("▁", " ").encode()
                self.ids[self.text[i]] = i
                score[i] = model.get_score(i)
        if (self.of_byte < 0).any():
            raise ValueError("the model has no piece for some byte")
        whole = bool((score == np.round(score)).all())
        # Whole numbers add up exactly; other scores are kept to a millionth.
        self.score = np.round(score if whole else score * 1e6).astype(np.int64)
        self.unknown = int(self.score.min()) - 10
        self.longest = max(map(len, self.ids))
        self.single = {p for p in self.ids if len(p.decode()) == 1}
        inside = [p for p in self.ids if b" " in p.lstrip(b" ")]
        if inside:
            raise ValueError(f"pieces with a space behind another character: {inside[:3]}")
        self.lengths = np.array([len(p) for p in self.text], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(self.text), np.uint8)
        self._tables()

    def _tables(self) -> None:
        """Piece ids by hash, for each length: a bit table that says no to most, then sorted keys."""
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for length in sorted({len(p) for p in self.ids}):
            own = [p for p in self.ids if len(p) == length]
            joined = np.frombuffer(b"".join(own), np.uint8)
            total = prefix_hash(joined)
            at = np.arange(len(own)) * length
            keys = (total[at + length] - total[at]) * powers(len(joined))[1][at]
            order = np.argsort(keys)
            table = np.zeros(1 << 16, bool)
            table[(keys >> np.uint64(48)).astype(np.int64)] = True
            self.by_length[length] = table, keys[order], np.array([self.ids[p] for p in own])[order]


class Stream:
    """Viterbi over a stream of bytes; ``feed`` returns the ids that no later byte can change."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.bytes = b""  # from the last commit on
        self.best, self.back, self.via = [0], [0], [-1]  # per place: score, length and id of the last piece
        self.done = 0  # places searched
        self.bare: list[bool] = []  # per byte: part of a character that is no piece

    def feed(self, data: bytes, last: bool = False) -> list[int]:
        out: list[int] = []
        # A character's bytes are searched together.
        self.bytes += data
        p = self.pieces
        while len(self.bare) < len(self.bytes):
            lead = self.bytes[len(self.bare)]
            n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            character = self.bytes[len(self.bare) : len(self.bare) + n]
            if len(character) < n and not last:
                break
            self.bare += [character not in p.single] * len(character)
        for end in range(self.done + 1, len(self.bare) + 1):
            score, length, via = _NEVER, 0, -1
            for n in range(min(p.longest, end), 0, -1):
                found = p.ids.get(self.bytes[end - n : end])
                if found is not None and self.best[end - n] > _NEVER:
                    total = self.best[end - n] + int(p.score[found])
                    if total > score:
                        score, length, via = total, n, found
            if self.bare[end - 1] and self.best[end - 1] > _NEVER:
                lead = self.bytes[end - 1] & 0xC0 != 0x80
                total = self.best[end - 1] + (p.unknown if lead else 0)
                if total > score:
                    score, length, via = total, 1, int(p.of_byte[self.bytes[end - 1]])
            self.best.append(score)
            self.back.append(length)
            self.via.append(via)
            self.done = end
            if end % (4 * p.longest) == 0:
                moved = self._commit(out)
                if moved:
                    return out + self.feed(b"", last)
        if last:
            out += self._path(self.done)
            self.__init__(p)
        return out

    def _path(self, place: int) -> list[int]:
        ids: list[int] = []
        while place > 0:
            ids.append(self.via[place])
            place -= self.back[place]
        return ids[::-1]

    def _commit(self, out: list[int]) -> int:
        """Commit up to the last place that the paths of all reachable places of the window share."""
        live = {e for e in range(max(self.done - self.pieces.longest + 1, 0), self.done + 1) if self.best[e] > _NEVER}
        while len(live) > 1:
            far = max(live)
            live.remove(far)
            live.add(far - self.back[far])
        place = live.pop()
        if not place:
            return 0
        out += self._path(place)
        base = self.best[place]
        self.best = [s - base if s > _NEVER else s for s in self.best[place:]]
        self.back, self.via = [0, *self.back[place + 1 :]], [-1, *self.via[place + 1 :]]
        self.bytes, self.bare, self.done = self.bytes[place:], self.bare[place:], self.done - place
        return place


def encode_stream(pieces: Pieces, parts: Iterable[bytes]) -> Iterator[int]:
    """Ids of one text that arrives in parts of any size."""
    stream, begun = Stream(pieces), False
    for part in parts:
        if part:
            yield from stream.feed(part if begun else b" " + part)
            begun = True
    if begun:
        yield from stream.feed(b"", last=True)


def encode_short(pieces: Pieces, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many stretches of at most ``SHORT`` bytes: flat ids and the stretches' offsets."""
    order = np.argsort(starts - ends, kind="stable")
    rows, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    total, back = prefix_hash(data), powers(len(data))[1]
    for at in range(0, len(order), TOGETHER):
        some = order[at : at + TOGETHER]
        row, own = _search_columns(pieces, data, total, back, starts[some], (ends - starts)[some])
        rows.append(some[row])
        ids.append(own)
    rows, ids = np.concatenate(rows), np.concatenate(ids)
    counts = np.bincount(rows, minlength=len(starts))
    return ids[np.argsort(rows, kind="stable")], np.concatenate(([0], np.cumsum(counts)))


def _search_columns(pieces: Pieces, data, total, back, starts, size) -> tuple[np.ndarray, np.ndarray]:
    """The search for stretches in falling order of length: rows and ids, a row's ids in order.

    Those that have a place ``end`` are a leading part, so every step works on whole columns.
    """
    longest = int(size[0])
    having = np.searchsorted(-size, -np.arange(longest + 1), side="right")  # stretches of at least that size
    column = [total[starts[: having[i]] + i] for i in range(longest + 1)]
    inverse = [back[starts[: having[i]] + i] for i in range(longest + 1)]
    best = [np.full(n, _NEVER, np.int64) for n in having]
    step = [np.zeros(n, np.int8) for n in having]
    via = [np.full(n, -1, np.int32) for n in having]
    best[0][:] = 0

    def lookup(begin: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        table, keys, ids = pieces.by_length[length]
        n = having[begin + length]
        h = (column[begin + length] - column[begin][:n]) * inverse[begin][:n]
        some = np.flatnonzero(table[(h >> np.uint64(48)).astype(np.int64)])
        place = np.minimum(np.searchsorted(keys, h[some]), len(keys) - 1)
        same = keys[place] == h[some]
        return some[same], ids[place[same]]

    # Bytes of characters that are no piece.
    bare = []
    for i in range(longest):
        n = having[i + 1]
        lead = data[starts[:n] + i]
        cover = np.zeros(n, bool)
        for length in range(1, min(4, longest - i) + 1):
            if length in pieces.by_length:
                hit, _ = lookup(i, length)
                first = data[starts[hit] + i]
                need = np.where(first < 0x80, 1, np.where(first < 0xE0, 2, np.where(first < 0xF0, 3, 4)))
                cover[hit[need == length]] = True
        tail = (lead & 0xC0) == 0x80
        bare.append(np.where(tail, bare[i - 1][:n] if i else False, ~cover))
    for end in range(1, longest + 1):
        for length in range(min(pieces.longest, end), 0, -1):
            if length in pieces.by_length:
                hit, ids = lookup(end - length, length)
                before = best[end - length][hit]
                score = before + pieces.score[ids]
                win = (score > best[end][hit]) & (before > _NEVER)
                hit = hit[win]
                best[end][hit], step[end][hit], via[end][hit] = score[win], length, ids[win]
        hit = np.flatnonzero(bare[end - 1])
        value, before = data[starts[hit] + end - 1], best[end - 1][hit]
        score = before + np.where((value & 0xC0) == 0x80, 0, pieces.unknown)
        win = (score > best[end][hit]) & (before > _NEVER)
        hit = hit[win]
        best[end][hit], step[end][hit], via[end][hit] = score[win], 1, pieces.of_byte[value[win]]
    # Back from the ends: all stretches that are at a place together.
    place = size.astype(np.int64)
    rows, found = [], []
    for end in range(longest, 0, -1):
        row = np.flatnonzero(place[: having[end]] == end)
        rows.append(row)
        found.append(via[end][row])
        place[row] -= step[end][row]
    # The last piece was found first.
    return np.concatenate(rows)[::-1], np.concatenate(found)[::-1]


def encode_block(pieces: Pieces, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the rows of a block: flat ids and the rows' offsets.  Empty rows have none."""
    rows = len(offsets) - 1
    full = np.diff(offsets) > 0
    # The dummy space in front of every row that has text.
    spaced = np.insert(data, offsets[:-1][full], 0x20)
    lead = np.concatenate(([0], np.cumsum(full)))
    at = offsets + lead
    space = spaced == 0x20
    begin = space.copy()
    begin[1:] &= ~space[:-1]
    begin[at[:-1][full]] = True
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], len(spaced))
    buffer = pa.py_buffer(spaced.tobytes())
    whole = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(spaced)).astype(np.int64)), buffer]
    )
    kinds = pc.dictionary_encode(whole)
    kind = kinds.indices.to_numpy()
    first = np.zeros(len(kinds.dictionary), np.int64)
    first[kind[::-1]] = np.arange(len(kind))[::-1]
    starts, ends = starts[first], ends[first]
    short = ends - starts <= SHORT
    ids, cut = encode_short(pieces, spaced, starts[short], ends[short])
    count = np.zeros(len(starts), np.int64)
    origin = np.zeros(len(starts), np.int64)
    count[short], origin[short] = np.diff(cut), cut[:-1]
    more = []
    used = len(ids)
    for i in np.flatnonzero(~short):
        stream = Stream(pieces)
        own: list[int] = []
        for a in range(starts[i], ends[i], 4096):
            own += stream.feed(spaced[a : min(a + 4096, ends[i])].tobytes())
        own += stream.feed(b"", last=True)
        count[i], origin[i] = len(own), used
        used += len(own)
        more.append(np.array(own, np.int32))
    pool = np.concatenate([ids.astype(np.int32), *more])
    n = count[kind]
    place = np.repeat(origin[kind] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    stretch_row = np.searchsorted(np.flatnonzero(begin), at)
    return pool[place], np.concatenate(([0], np.cumsum(n)))[stretch_row] if rows else np.zeros(1, np.int64)


def decode_block(pieces: Pieces, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the rows and their offsets: the pieces joined, without the dummy space."""
    n = pieces.lengths[ids]
    total = np.concatenate(([0], np.cumsum(n)))
    place = np.repeat(pieces.starts[ids] - total[:-1], n) + np.arange(total[-1])
    joined, at = pieces.blob[place], total[offsets]
    full = np.diff(at) > 0
    return np.delete(joined, at[:-1][full]), at - np.concatenate(([0], np.cumsum(full)))


_loaded: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    """The model, read once in each worker process."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(
        pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data.tobytes())]
    )


def _append(docs: DataFrame, make, added: list[tuple[str, str]], source: str) -> DataFrame:
    """``docs`` with columns that ``make(array, first row, rows)`` computes from ``source`` in blocks."""
    ship(docs.sparkSession)
    new = [n for n, _ in added]
    fields = [f for f in docs.schema.fields if f.name not in new]
    names = [f.name for f in fields]
    at = [f.name for f in docs.schema.fields].index(source)
    columns = [docs.columns.index(n) for n in names]

    def run(batches):
        for batch in batches:
            for row, n, arrays in make(batch.column(at)):
                out = [batch.column(i).slice(row, n) for i in columns]
                yield pa.RecordBatch.from_arrays([*out, *arrays], [*names, *new])

    return docs.mapInArrow(run, T.StructType([*fields, *(T.StructField(n, T.DataType.fromDDL(t)) for n, t in added)]))


def encode(docs: DataFrame, model: str = MODEL, text: str = "text") -> DataFrame:
    """``docs`` with ``ids array<int>``: null for a null text, empty for an empty one."""

    def make(column):
        pieces = pieces_of(model)
        texts = column.cast(pa.string())
        missing = texts.is_null().to_numpy(zero_copy_only=False)
        for row, data, offsets in text_blocks(texts, BLOCK_TEXT):
            ids, at = encode_block(pieces, data, offsets)
            n = len(offsets) - 1
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids), mask=pa.array(missing[row : row + n]))
            yield row, n, [lists]

    return _append(docs, make, [("ids", "array<int>")], text)


def decode(docs: DataFrame, model: str = MODEL, ids: str = "ids") -> DataFrame:
    """``docs`` with ``decoded string``, the exact text that was encoded."""

    def make(column):
        pieces = pieces_of(model)
        step = 256
        for row in range(0, len(column), step):
            part = column.slice(row, step)
            size = pc.fill_null(pc.list_value_length(part), 0).to_numpy()
            at = np.concatenate(([0], np.cumsum(size)))
            data, offsets = decode_block(pieces, part.flatten().to_numpy(), at)
            strings = pc.if_else(part.is_null(), pa.scalar(None, pa.large_string()), _strings(data, offsets))
            yield row, len(part), [strings.cast(pa.string())]

    return _append(docs, make, [("decoded", "string")], ids)
