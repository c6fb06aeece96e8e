"""SentencePiece encoding by a max-plus scan, and decoding.

The encoding of a text is the segmentation of its normalised form into pieces
of the model with the largest total score; of equal ones that whose last piece
starts earliest, then the same for the rest (what a left-to-right Viterbi
pass with strict improvement yields).  Characters without a piece become byte
pieces.  This is the encoding of a unigram model.  A model of BPE type has no
such scores: its pieces get those of a Zipf law over their ranks (see
``zipf_scores``), which makes it a unigram model over the same vocabulary.
All scores are rounded to sixteenths, so sums are exact.  The encoding by the
merges of a BPE model is another one: ``sentencepiece_bpe`` gives that.

A text of more than ``chunk`` characters is cut into chunks.  The state at a
cut is the number of characters by which the piece that crosses it reaches
beyond.  Per chunk, in parallel:

1. the transfer matrix: best score from every entry state to every exit state;
2. the matrices combine in the (max, +) semiring, an associative product:
   blocks of chunks first, then the blocks of a document, then back down, which
   gives the vector of best scores before every chunk;
3. with its vector, a chunk knows for every exit state the entry state that
   the best segmentation comes from; these maps compose from the end of the
   document to the states on the best path;
4. every chunk is backtraced on its own between its two states.

Vectors are shifted so that their largest entry is 0, so scores stay exact at
any length.  The text of a chunk is read once: with its matrix, a chunk leaves
the pieces of its whole words and the few characters before its first and from
its last word start on, which is all that the later steps need.  Words (a run of spaces and what follows
up to the next space) are independent where no piece has a space inside, so
each distinct word of a batch is segmented once, all words side by side.

Normalisation is the one of the model at hand, and others are refused: one
space in front of a text that is not empty, spaces written as U+2581.
Decoding reverses it; a U+2581 of the text itself reads back as a space, as in
the library.

Defined cases: null and empty texts have no piece; nothing is cut off; rows
come back as often as they came; other columns are carried along.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.llm.common import Workspace, texts_of, tidy
from encore.llm.text import mix, powers

#: Characters of a chunk; shorter texts are one.
CHUNK = 16384
#: Characters up to which a text's chunks are opened where the text is read;
#: those of longer ones are dealt out to other tasks first.
DEAL = 1 << 20
#: Rows of an Arrow batch of whole texts.
ROWS = 128
#: Chunks combined in one task before the blocks of a document are.
COMBINE = 64
#: Bytes of texts segmented side by side.
BATCH_BYTES = 4 << 20
#: Words whose segmentation a worker keeps.
KNOWN = 250_000
SPACE = "▁"
_SPACE_CODE = 0x2581
_LOST = -np.inf
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_LOOK_BITS = 20
_BASE = 0x5851F42D4C957F2D


class KnownWords:
    """Segmentations of words met before, by hash; the first KNOWN words that
    a worker meets are kept, the others are solved again when they come."""

    def __init__(self):
        self.hashes, self.first, self.count = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.score, self.ids = np.empty(0), np.empty(0, np.int32)
        self.waiting: list[tuple] = []
        self.n_waiting = 0

    def look_up(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(where the ids begin or -1, how many, score)."""
        if not len(self.hashes):
            return np.full(len(value), -1), np.zeros(len(value), np.int64), np.zeros(len(value))
        at = np.searchsorted(self.hashes, value)
        at[at == len(self.hashes)] = 0
        hit = self.hashes[at] == value
        return np.where(hit, self.first[at], -1), np.where(hit, self.count[at], 0), np.where(hit, self.score[at], 0.0)

    def add(self, value: np.ndarray, count: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Words (no two alike) with their ids one after another; they are
        merged in once enough wait."""
        if len(self.hashes) + self.n_waiting >= KNOWN:
            return
        self.waiting.append((value, count, score, ids))
        self.n_waiting += len(value)
        if self.n_waiting < 20_000 + len(self.hashes) // 4:
            return
        value, count, score, ids = (np.concatenate(x) for x in zip(*self.waiting, strict=True))
        first = np.cumsum(count) - count + len(self.ids)
        value, one = np.unique(value, return_index=True)
        at = np.searchsorted(self.hashes, value)
        fresh = np.ones(len(value), dtype=bool)
        if len(self.hashes):
            fresh = self.hashes[np.minimum(at, len(self.hashes) - 1)] != value
        at, value, one = at[fresh], value[fresh], one[fresh]
        self.hashes, self.first, self.count, self.score = (np.insert(x, at, y) for x, y in (
            (self.hashes, value), (self.first, first[one]), (self.count, count[one]), (self.score, score[one])))
        self.ids = np.concatenate((self.ids, ids))
        self.waiting, self.n_waiting = [], 0


def zipf_scores(ranks: np.ndarray) -> np.ndarray:
    """Logarithms of the probabilities that Zipf's law (with Mandelbrot's
    offset) gives to these ranks, in sixteenths."""
    weight = 1.0 / (ranks + 2.7)
    return np.round(16 * np.log(weight / weight.sum())) / 16


_UNIGRAM, _BPE = 1, 2


class Pieces:
    """The model's pieces, looked up by hash, all positions at once."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as model_pb2

        model = model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or not spec.add_dummy_prefix or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("this model normalises texts in another way")
        vocabulary = sentencepiece.SentencePieceProcessor(model_file=path)
        self.names = [p.piece for p in model.pieces]
        self.byte_ids = np.full(256, -1, dtype=np.int32)
        self.normal = np.zeros(len(self.names), dtype=bool)
        scores = np.zeros(len(self.names))
        for i, p in enumerate(model.pieces):
            scores[i] = p.score
            if p.type == p.BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
            elif p.type in (p.NORMAL, p.USER_DEFINED):
                self.normal[i] = True
        self.unknown_id = vocabulary.unk_id()
        normal = np.flatnonzero(self.normal)
        kind = model.trainer_spec.model_type
        if kind not in (_UNIGRAM, _BPE):
            raise ValueError("this model is neither of unigram nor of BPE type")
        if kind == _BPE:
            scores[normal] = zipf_scores(-scores[normal])
        else:
            scores[normal] = np.round(16 * scores[normal]) / 16
        self.scores = scores
        self.longest = max(len(self.names[i]) for i in normal)
        self.unknown_score = float(scores[normal].min()) - 10.0
        # a piece with a space after another character would join two words
        self.words = not any(SPACE in self.names[i].lstrip(SPACE) for i in normal)
        self.raw = [n.encode() if ok else b"" for n, ok in zip(self.names, self.normal.tolist(), strict=True)]
        self.raw[self.unknown_id] = " \u2047 ".encode()
        for byte, i in enumerate(self.byte_ids):
            if i >= 0:
                self.raw[i] = bytes([byte])
        self.known = KnownWords()
        self.tables = []
        for n in range(1, self.longest + 1):
            ids = [int(i) for i in normal if len(self.names[i]) == n]
            codes = np.array([[ord(c) for c in self.names[i]] for i in ids], dtype=np.uint64).reshape(len(ids), n)
            value = np.zeros(len(ids), dtype=np.uint64)
            for j in range(n):
                value = _roll(value, codes[:, j])
            order = np.argsort(value)
            look = np.zeros(1 << _LOOK_BITS, dtype=bool)
            look[_look(value)] = True
            self.tables.append((value[order], np.array(ids, dtype=np.int32)[order], look))

    def matches(self, codes: np.ndarray, room: np.ndarray):
        """(start, length, id, score) of every piece that lies at a position
        with at least its length of ``room``; unknown characters included."""
        at = np.arange(len(codes))
        value = np.zeros(len(codes), dtype=np.uint64)
        out = []
        for n, (hashes, ids, look) in enumerate(self.tables, 1):
            fits = room[at] >= n
            at, value = at[fits], value[fits]
            if not len(at):
                break
            value = _roll(value, codes[at + n - 1])
            maybe = np.flatnonzero(look[_look(value)])
            place = np.searchsorted(hashes, value[maybe])
            place[place == len(hashes)] = 0
            hit = hashes[place] == value[maybe] if len(hashes) else np.zeros(0, bool)
            start, which = at[maybe[hit]], ids[place[hit]]
            out.append((start, np.full(len(start), n), which, self.scores[which]))
            if n == 1:
                none = np.ones(len(codes), dtype=bool)
                none[start] = False
                none = np.flatnonzero(none & (room >= 1))
                out.append((none, np.ones(len(none), dtype=np.int64), np.full(len(none), -1, np.int32), np.full(len(none), self.unknown_score)))
        return [np.concatenate(x) for x in zip(*out, strict=True)]

    def expand(self, ids: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte pieces in place of unknown characters (``codes``: the last
        character of each piece); and how many pieces each became."""
        count = np.ones(len(ids), dtype=np.int64)
        lost = np.flatnonzero(ids < 0)
        if not len(lost):
            return ids, count
        data = [self.byte_ids[list(chr(c).encode("utf-8", "surrogatepass"))] for c in codes[lost].tolist()]
        data = [d if d.min() >= 0 else np.array([self.unknown_id], dtype=np.int32) for d in data]
        count[lost] = [len(d) for d in data]
        out = np.repeat(ids, count)
        at = np.repeat((np.cumsum(count) - count)[lost], count[lost]) + _ramp(count[lost])
        out[at] = np.concatenate(data)
        return out, count

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The text that the ids stand for, in UTF-8."""
        data = b"".join(map(self.raw.__getitem__, np.asarray(ids).tolist())).replace(SPACE.encode(), b" ")
        return data[1:] if data.startswith(b" ") else data

    def decode(self, ids) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def _roll(value: np.ndarray, code: np.ndarray) -> np.ndarray:
    value = (value + code + np.uint64(1)) * _FACTOR
    return value ^ (value >> np.uint64(29))


def _look(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(64 - _LOOK_BITS)).astype(np.int64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def normalised(text: str) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""


def solve(pieces: Pieces, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Best segmentation of the stretches [start, end) side by side: the ids
    and last positions of their pieces, in order, and where each stretch's
    begin.  The stretches do not overlap."""
    size = len(codes)
    room = np.zeros(size, dtype=np.int64)
    offset = np.zeros(size, dtype=np.int64)
    lengths = ends - starts
    flat = np.repeat(starts, lengths) + _ramp(lengths)
    room[flat] = np.repeat(ends, lengths) - flat
    offset[flat] = _ramp(lengths)
    start, length, which, score = pieces.matches(codes, room)
    # small numbers sort by radix
    order = np.argsort(offset[start].astype(np.uint16) if int(lengths.max(initial=0)) < 1 << 16 else offset[start], kind="stable")
    start, length, which, score = start[order], length[order], which[order], score[order]
    steps = np.searchsorted(offset[start], np.arange(int(lengths.max(initial=0)) + 1))
    # best[p]: of the stretch up to and without p, kept at the position before p
    best = np.full(size + 1, _LOST)
    from_start = np.zeros(size + 1, dtype=np.int64)
    piece = np.zeros(size + 1, dtype=np.int32)
    head = np.zeros(size + 1, dtype=bool)
    head[starts] = True
    for a, b in zip(steps, np.append(steps[1:], len(start)), strict=True):
        if a == b:
            continue
        s, e = start[a:b], start[a:b] + length[a:b] - 1
        total = np.where(head[s], 0.0, best[s - 1]) + score[a:b]
        better = total > best[e]
        e = e[better]
        best[e], from_start[e], piece[e] = total[better], s[better], which[a:b][better]
    on_path = np.zeros(size + 1, dtype=bool)
    now, low = ends - 1, starts
    alive = lengths > 0
    now, low = now[alive], low[alive]
    while len(now):
        on_path[now] = True
        now = from_start[now] - 1
        alive = now >= low
        now, low = now[alive], low[alive]
    last = np.flatnonzero(on_path)
    return piece[last], last, np.searchsorted(last, starts), np.searchsorted(last, ends)


def _ramp(lengths: np.ndarray) -> np.ndarray:
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _word_starts(codes: np.ndarray, words: bool) -> np.ndarray:
    """Positions inside a stretch where no piece can cross."""
    if not words:
        return np.empty(0, dtype=np.int64)
    space = codes == _SPACE_CODE
    return np.flatnonzero(space[1:] & ~space[:-1]) + 1


def encode_batch(pieces: Pieces, texts: list[str]) -> list[np.ndarray]:
    """Ids of whole texts; every distinct word is segmented once."""
    full = [normalised(t) for t in texts]
    codes = code_points("".join(full))
    edges = np.cumsum([0] + [len(t) for t in full])
    if not len(codes):
        return [np.empty(0, np.int32) for _ in texts]
    head = np.zeros(len(codes), dtype=bool)
    head[edges[:-1][np.diff(edges) > 0]] = True
    head[_word_starts(codes, pieces.words)] = True
    heads = np.flatnonzero(head)
    tails = np.append(heads[1:], len(codes))
    ids, count, _ = segment(pieces, codes, heads, tails)
    cut = np.concatenate(([0], np.cumsum(count)))[np.searchsorted(heads, edges)]
    return [ids[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def segment(pieces: Pieces, codes: np.ndarray, heads: np.ndarray, tails: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words [head, tail), one after another: all ids in order, and per
    word how many and the score.  Every distinct word is segmented once."""
    # distinct words by a 64-bit hash of their characters
    total = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.multiply(codes + np.uint64(1), powers(_BASE, len(codes)), out=total[1:])
    np.cumsum(total, out=total)
    value = mix((total[tails] - total[heads]) * powers(pow(_BASE, -1, 1 << 64), len(codes))[heads]) + (tails - heads).astype(np.uint64)
    order = np.argsort(value)
    new = np.concatenate(([True], value[order][1:] != value[order][:-1]))
    group = np.empty(len(heads), dtype=np.int64)
    group[order] = np.cumsum(new) - 1
    chosen = order[new]
    first, count, score = pieces.known.look_up(value[chosen])
    ids = pieces.known.ids
    miss = np.flatnonzero(first < 0)
    if len(miss):
        # the words not met before, one after another
        some = chosen[miss]
        lengths = (tails - heads)[some]
        own = codes[np.repeat(heads[some], lengths) + _ramp(lengths)]
        begin = np.cumsum(lengths) - lengths
        found, last, low, high = solve(pieces, own, begin, begin + lengths)
        score[miss] = np.add.reduceat(np.where(found >= 0, pieces.scores[found], pieces.unknown_score), low)
        found, became = pieces.expand(found, own[last])
        place = np.concatenate(([0], np.cumsum(became)))
        first[miss] = place[low] + len(ids)
        count[miss] = place[high] - place[low]
        ids = np.concatenate((ids, found))
        pieces.known.add(value[some], count[miss], score[miss], found)
    count = count[group]
    return ids[np.repeat(first[group], count) + _ramp(count)], count, score[group]


def _forward(pieces: Pieces, codes: np.ndarray, begin: int, entry: np.ndarray | None):
    """Scores and pieces over ``codes``: from ``entry`` (state s enters at s)
    or from the start alone; only pieces that start before ``begin``."""
    n = len(codes)
    score = np.full(n + 1, _LOST)
    back = np.full(n + 1, -1, dtype=np.int64)
    piece = np.full(n + 1, -1, dtype=np.int32)
    if entry is None:
        score[0] = 0.0
    else:
        k = min(len(entry), n + 1)
        score[:k] = entry[:k]
    if n:
        room = np.minimum(np.arange(n, 0, -1), pieces.longest)
        room[begin:] = 0
        start, length, which, value = pieces.matches(codes, room)
        order = np.lexsort((length, start))
        for s, m, w, v in zip(start[order].tolist(), length[order].tolist(), which[order].tolist(), value[order].tolist(), strict=True):
            total = score[s] + v
            if total > score[s + m]:
                score[s + m], back[s + m], piece[s + m] = total, s, w
    return score, back, piece


def _walk(back: np.ndarray, at: int) -> list[int]:
    """Positions of the path that ends at ``at``, last first."""
    path = [at]
    while back[path[-1]] >= 0:
        path.append(int(back[path[-1]]))
    return path


class Ends:
    """The ends of a chunk.  ``head``: the characters before its first word
    start; ``tail``: those from its last word start on, to where no piece of
    that word reaches any more, ``room`` of them inside the chunk.  In a chunk
    without a word start ``head`` is all of it and ``tail`` is None."""

    def __init__(self, pieces: Pieces, head: np.ndarray, tail: np.ndarray | None, room: int):
        self.pieces, self.head, self.tail, self.room = pieces, head, tail, room

    def leaving(self, score: np.ndarray) -> np.ndarray:
        out = np.full(self.pieces.longest, _LOST)
        have = score[self.room:][:self.pieces.longest]
        out[:len(have)] = have
        return out

    def through(self, middle: float) -> np.ndarray:
        """Best score from entry state to exit state."""
        states = self.pieces.longest
        out = np.full((states, states), _LOST)
        leave = None if self.tail is None else self.leaving(_forward(self.pieces, self.tail, self.room, None)[0])
        for s in range(min(states, len(self.head) + 1)):
            entry = np.full(states, _LOST)
            entry[s] = 0.0
            if self.tail is None:
                out[s] = self.leaving(_forward(self.pieces, self.head, self.room, entry)[0])
            else:
                out[s] = _forward(self.pieces, self.head, len(self.head), entry)[0][-1] + middle + leave
        return out

    def entry_states(self, entry: np.ndarray) -> list[int]:
        """For every exit state the entry state on the best path, or -1."""
        states = self.pieces.longest
        if self.tail is not None:
            _, back, _ = _forward(self.pieces, self.head, len(self.head), entry)
            return [_walk(back, len(self.head))[-1]] * states
        score, back, _ = _forward(self.pieces, self.head, self.room, entry)
        out = []
        for s in range(states):
            at = self.room + s
            out.append(_walk(back, at)[-1] if at < len(score) and np.isfinite(score[at]) else -1)
        return out

    def _traced(self, codes: np.ndarray, back: np.ndarray, piece: np.ndarray, at: int) -> np.ndarray:
        path = np.array(_walk(back, at)[:-1][::-1], dtype=np.int64)
        return self.pieces.expand(piece[path], codes[path - 1])[0]

    def tokens(self, entry: np.ndarray, leave: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces before and after the whole words, on the best
        path that leaves in state ``leave``."""
        if self.tail is None:
            _, back, piece = _forward(self.pieces, self.head, self.room, entry)
            return self._traced(self.head, back, piece, self.room + leave), np.empty(0, np.int32)
        _, back, piece = _forward(self.pieces, self.head, len(self.head), entry)
        before = self._traced(self.head, back, piece, len(self.head))
        _, back, piece = _forward(self.pieces, self.tail, self.room, None)
        return before, self._traced(self.tail, back, piece, self.room + leave)


class Chunk:
    """One chunk [0, size) of a normalised text with the characters that
    follow it, as far as a piece that starts inside may reach."""

    def __init__(self, pieces: Pieces, codes: np.ndarray, size: int):
        starts = _word_starts(codes, pieces.words)
        inside = starts[starts < size]
        beyond = starts[starts >= size]
        reach = int(beyond[0]) if len(beyond) else len(codes)  # no piece of the last word goes further
        if len(inside):
            first, last = int(inside[0]), int(inside[-1])
            self.ends = Ends(pieces, codes[:first], codes[last:reach], size - last)
        else:
            first = last = 0
            self.ends = Ends(pieces, codes[:reach], None, size)
        self.ids, score = np.empty(0, np.int32), 0.0
        if last > first:
            heads = np.concatenate(([0], _word_starts(codes[first:last], True)))
            self.ids, _, scores = segment(pieces, codes[first:last], heads, np.append(heads[1:], last - first))
            score = float(scores.sum())
        self.score = score

    def matrix(self) -> np.ndarray:
        return self.ends.through(self.score)

    def entry_states(self, entry: np.ndarray) -> list[int]:
        return self.ends.entry_states(entry)

    def tokens(self, entry: np.ndarray, leave: int) -> np.ndarray:
        before, after = self.ends.tokens(entry, leave)
        return np.concatenate((before, self.ids, after))


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product in the (max, +) semiring, shifted to a largest entry of 0."""
    out = (a[:, :, None] + b[None, :, :]).max(axis=1)
    top = out.max()
    return out - top if np.isfinite(top) else out


def _load(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


_loaded: dict[str, Pieces] = {}


def chunk_rows(text: str, chunk: int, longest: int) -> list[tuple[int, str, int]]:
    """(number, characters with what follows, size) of the chunks."""
    full = normalised(text)
    return [(i, full[at:at + chunk + longest - 1], min(chunk, len(full) - at)) for i, at in enumerate(range(0, len(full), chunk))]


def _text_of(codes: np.ndarray | None) -> str | None:
    return None if codes is None else codes.tobytes().decode("utf-32-le", "surrogatepass")


def read_back(text: str) -> str:
    """Digest of what a text's ids decode to."""
    return hashlib.sha256(text.encode("utf-8", "surrogatepass").replace(SPACE.encode(), b" ")).hexdigest()


def _told(pieces: Pieces, ids: np.ndarray, want: str) -> tuple[int, str, bool]:
    """Number and digest of the ids, and whether they decode to the text."""
    return len(ids), hashlib.sha256(np.asarray(ids, "<i4").tobytes()).hexdigest(), hashlib.sha256(pieces.decode_bytes(ids)).hexdigest() == want


_TOLD = [("n", pa.int64()), ("sha", pa.string()), ("ok", pa.bool_())]
_OPENED = [("ids", pa.list_(pa.int32())), *_TOLD, ("rid", pa.int64()), ("no", pa.int32()), ("m", pa.list_(pa.float64())),
           ("head", pa.string()), ("tail", pa.string()), ("room", pa.int32()), ("want", pa.string())]
_OPENED_SQL = "ids array<int>, n long, sha string, ok boolean, rid long, no int, m array<double>, head string, tail string, room int, want string"


def _chunk_row(rid: int, no: int, chunk: Chunk, want: str | None) -> tuple:
    ends = chunk.ends
    return (chunk.ids, None, None, None, rid, no, chunk.matrix().ravel(), _text_of(ends.head), _text_of(ends.tail), ends.room, want)


def _opened(batch: pa.RecordBatch, fields: list[str], at: list[int | None], rows: list[tuple]) -> pa.RecordBatch:
    """Rows with the columns ``fields`` of the row ``at`` of the batch."""
    where = pa.array(at, pa.int32())
    carried = [batch.column(batch.schema.get_field_index(f)).take(where) for f in fields]
    made = [pa.array(c, kind) for c, (_, kind) in zip(zip(*rows, strict=True), _OPENED, strict=True)]
    return pa.RecordBatch.from_arrays([*carried, *made], [*fields, *(n for n, _ in _OPENED)])


def _open(path: str, fields: list[str], chunk: int, with_ids: bool):
    """Short texts encoded, the chunks of long ones opened."""
    @tidy
    def run(batches):
        pieces = _load(path)
        for batch in batches:
            texts = [t.decode("utf-8", "surrogatepass") for t in texts_of(batch, "_text")]
            rids = batch.column(batch.schema.get_field_index("_rid")).to_pylist()
            at: list[int | None] = []
            rows: list[tuple] = []
            held: list[int] = []
            size = 0

            def short() -> None:
                nonlocal held, size
                for i, ids in zip(held, encode_batch(pieces, [texts[j] for j in held]), strict=True):
                    at.append(i)
                    rows.append((ids if with_ids else None, *_told(pieces, ids, read_back(texts[i])), *[None] * 7))
                held, size = [], 0

            for i, text in enumerate(texts):
                if len(text) < chunk:
                    held.append(i)
                    size += len(text)
                    if size > BATCH_BYTES // 4:
                        short()
                    continue
                for no, part, n in chunk_rows(text, chunk, pieces.longest):
                    at.append(None if no else i)
                    rows.append(_chunk_row(rids[i], no, Chunk(pieces, code_points(part), n), None if no else read_back(text)))
            if held:
                short()
            if rows:
                yield _opened(batch, fields, at, rows)

    return run


def _deal(path: str, fields: list[str], chunk: int):
    """The chunks of very long texts, with the row's columns at the first."""
    @tidy
    def run(batches):
        longest = _load(path).longest
        for batch in batches:
            rids = batch.column(batch.schema.get_field_index("_rid")).to_pylist()
            for i, text in enumerate(texts_of(batch, "_text")):
                text = text.decode("utf-8", "surrogatepass")
                for no, part, n in chunk_rows(text, chunk, longest):
                    where = pa.array([None if no else i], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(batch.schema.get_field_index(f)).take(where) for f in fields), pa.array([rids[i]], pa.int64()), pa.array([no], pa.int32()),
                         pa.array([part], pa.string()), pa.array([n], pa.int32()), pa.array([None if no else read_back(text)], pa.string())],
                        [*fields, "rid", "no", "part", "size", "want"])

    return run


def _open_dealt(path: str, fields: list[str]):
    @tidy
    def run(batches):
        pieces = _load(path)
        for batch in batches:
            rid, no, part, size, want = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("rid", "no", "part", "size", "want"))
            rows = [_chunk_row(r, k, Chunk(pieces, code_points(p), n), w) for r, k, p, n, w in zip(rid, no, part, size, want, strict=True)]
            if rows:
                yield _opened(batch, fields, list(range(len(rows))), rows)

    return run


def _square(flat) -> np.ndarray:
    flat = np.asarray(flat, dtype=np.float64)
    n = int(round(len(flat) ** 0.5))
    return flat.reshape(n, n)


def _block_product(frame):
    import pandas as pd

    frame = frame.sort_values("no")
    out = None
    for m in frame["m"]:
        out = _square(m) if out is None else max_plus(out, _square(m))
    return pd.DataFrame({"rid": [frame["rid"].iloc[0]], "block": [frame["block"].iloc[0]], "m": [out.ravel()]})


def _scan(frame, name: str):
    """The vector before every row of one document (or block), in order;
    ``v`` holds the vector before the first, if it is not the start."""
    import pandas as pd

    frame = frame.sort_values(name)
    first = frame["v"].iloc[0] if "v" in frame else None
    vectors, now = [], None
    for m in frame["m"]:
        square = _square(m)
        if now is None:
            if first is None:
                now = np.full(len(square), _LOST)
                now[0] = 0.0
            else:
                now = np.asarray(first, dtype=np.float64)
        vectors.append(now)
        now = max_plus(now[None, :], square)[0]
    return pd.DataFrame({"rid": frame["rid"].to_numpy(), name: frame[name].to_numpy(), "v": vectors})


def _ends_of(batch, pieces: Pieces):
    head, tail, room = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("head", "tail", "room"))
    for h, t, n in zip(head, tail, room, strict=True):
        yield Ends(pieces, code_points(h), None if t is None else code_points(t), n)


def _entry_maps(path: str):
    @tidy
    def run(batches):
        pieces = _load(path)
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("v")).to_pylist()
            rows = [e.entry_states(np.array(v)) for e, v in zip(_ends_of(batch, pieces), vectors, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.int32()))], ["rid", "no", "enter"])

    return run


def _states(frame):
    """Exit state of every chunk of one document, from its end."""
    import pandas as pd

    frame = frame.sort_values("no", ascending=False)
    leave, now = [], 0
    for enter in frame["enter"]:
        leave.append(now)
        now = int(enter[now])
    return pd.DataFrame({"rid": frame["rid"].to_numpy(), "no": frame["no"].to_numpy(), "leave": leave})


def _traced(path: str):
    """The ids around the whole words of each chunk: (rid, no, place, ids)."""
    @tidy
    def run(batches):
        pieces = _load(path)
        for batch in batches:
            vectors, leave = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("v", "leave"))
            pairs = [e.tokens(np.array(v), s) for e, v, s in zip(_ends_of(batch, pieces), vectors, leave, strict=True)]
            for place in (0, 2):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([place] * len(pairs), pa.int32()), pa.array([p[place // 2] for p in pairs], pa.list_(pa.int32()))],
                    ["rid", "no", "place", "ids"])

    return run


def _finish(path: str, fields: list[str], with_ids: bool):
    @tidy
    def run(batches):
        pieces = _load(path)
        for batch in batches:
            ids = [np.asarray(x.values, dtype=np.int32) for x in batch.column(batch.schema.get_field_index("ids"))]
            want = batch.column(batch.schema.get_field_index("want")).to_pylist()
            told = list(zip(*[_told(pieces, i, w) for i, w in zip(ids, want, strict=True)], strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(f)) for f in fields), pa.array(ids if with_ids else [None] * len(ids), pa.list_(pa.int32())),
                 *(pa.array(c, kind) for c, (_, kind) in zip(told, _TOLD, strict=True))], [*fields, "ids", "n", "sha", "ok"])

    return run


def _scanned(ws: Workspace, chunks: DataFrame, path: str) -> DataFrame:
    """(rid, no, place, ids) of opened chunks, in the order of which they make
    up the ids of their texts."""
    # few bytes are much work here: a fixed number of tasks, which run-time
    # planning does not merge
    tasks = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    matrices = chunks.select("rid", "no", "m", F.expr(f"no div {COMBINE}").cast("int").alias("block"))
    blocks = matrices.repartition(tasks, "rid", "block").groupBy("rid", "block").applyInPandas(_block_product, "rid long, block int, m array<double>")
    before = ws.put(blocks.groupBy("rid").applyInPandas(lambda f: _scan(f, "block"), "rid long, block int, v array<double>"))
    vectors = matrices.join(before, ["rid", "block"]).repartition(tasks, "rid", "block").groupBy("rid", "block").applyInPandas(
        lambda f: _scan(f, "no"), "rid long, no int, v array<double>")
    entered = ws.put(chunks.select("rid", "no", "head", "tail", "room").join(vectors, ["rid", "no"]))
    maps = entered.repartition(tasks, "rid", "no").mapInArrow(_entry_maps(path), "rid long, no int, enter array<int>")
    leave = ws.put(maps.groupBy("rid").applyInPandas(_states, "rid long, no int, leave int"))
    around = entered.join(leave, ["rid", "no"]).repartition(tasks, "rid", "no").mapInArrow(_traced(path), "rid long, no int, place int, ids array<int>")
    return chunks.select("rid", "no", F.lit(1).alias("place"), "ids").unionByName(around)


def _encoded(docs: DataFrame, path: str, text_col: str, chunk: int, keep: list[str], with_ids: bool) -> DataFrame:
    """The columns ``keep`` of ``docs``, then ids, n, sha and ok of the whole
    text, all staged."""
    ws = Workspace(docs.sparkSession, "sentencepiece")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = [f"c{i}" for i in range(len(keep))]
    kinds = [T.StructField(f, docs.schema[c].dataType) for f, c in zip(fields, keep, strict=True)]
    made = T._parse_datatype_string(_OPENED_SQL).fields
    text = F.coalesce(F.col(text_col), F.lit(""))

    def named(rows: DataFrame, odd: int) -> DataFrame:
        return rows.select(*[F.col(c).alias(f) for f, c in zip(fields, keep, strict=True)], text.alias("_text"),
                           (F.monotonically_increasing_id() * 2 + odd).alias("_rid"))

    deal = max(DEAL, chunk)
    here = named(docs.where(F.length(text) <= deal), 0).mapInArrow(_open(path, fields, chunk, with_ids), T.StructType([*kinds, *made]))
    parts = T.StructType([*kinds, *T._parse_datatype_string("rid long, no int, part string, size int, want string").fields])
    dealt = named(docs.where(F.length(text) > deal), 1).mapInArrow(_deal(path, fields, chunk), parts).repartition(tasks, "rid", "no")
    opened = ws.put(here.unionByName(dealt.mapInArrow(_open_dealt(path, fields), T.StructType([*kinds, *made]))), text_batch=ROWS, compression="zstd")
    chunks = opened.where("rid is not null")
    pieces = _scanned(ws, chunks, path).select("rid", "no", "place", "ids", F.lit(None).cast(T.StructType([*kinds, made[-1]])).alias("row"))
    rows = chunks.where("no = 0").select("rid", F.lit(-1).alias("no"), F.lit(0).alias("place"), F.lit(None).cast("array<int>").alias("ids"),
                                         F.struct(*fields, "want").alias("row"))
    put_together = pieces.unionByName(rows).groupBy("rid").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col("ids").isNotNull(), F.struct("no", "place", "ids")))), lambda x: x["ids"])).alias("ids"),
        F.first("row", ignorenulls=True).alias("row"))
    told = [f for f in made if f.name in ("ids", "n", "sha", "ok")]
    finished = ws.put(put_together.select("row.*", "ids").mapInArrow(_finish(path, fields, with_ids), T.StructType([*kinds, *told])), text_batch=ROWS)
    out = opened.where("rid is null").select(*fields, "ids", "n", "sha", "ok").unionByName(finished)
    return out.withColumnsRenamed({f: f"_{f}" for f in fields}).select(*[F.col(f"_{f}").alias(c) for f, c in zip(fields, keep, strict=True)],
                                                                      F.col("ids").alias("_ids"), F.col("n").alias("_n"), F.col("sha").alias("_sha"), F.col("ok").alias("_ok"))


def encode(docs: DataFrame, model_path: str, text_col: str = "text", chunk: int = CHUNK, ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with ``ids_col``, the piece ids of the whole text."""
    names = docs.columns
    return _encoded(docs, model_path, text_col, chunk, names, True).select(*names, F.col("_ids").alias(ids_col))


def encode_only(docs: DataFrame, model_path: str, text_col: str = "text", chunk: int = CHUNK, ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with ``ids_col``, n_tokens and round_trip (whether the ids were
    decoded to the text again) in place of the text."""
    names = [c for c in docs.columns if c != text_col]
    return _encoded(docs, model_path, text_col, chunk, names, True).select(
        *names, F.col("_ids").alias(ids_col), F.col("_n").alias("n_tokens"), F.col("_ok").alias("round_trip"))


def decode(frame: DataFrame, model_path: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``frame`` with ``out_col``, the text that the ids stand for."""
    names = frame.columns
    kept = frame.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])
    where = f"c{names.index(ids_col)}"
    schema = T.StructType([*kept.schema.fields, T.StructField("out", T.StringType())])

    @tidy
    def run(batches):
        pieces = _load(model_path)
        for batch in batches:
            texts = [pieces.decode(ids or []) for ids in batch.column(batch.schema.get_field_index(where)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "out"])

    return kept.mapInArrow(run, schema).toDF(*names, out_col)


def token_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """Returns (id_col, n_pieces, pieces_sha256, round_trip) per row: the
    encoding of the whole text, and whether it decodes to the text."""
    return _encoded(docs, model_path, text_col, chunk, [id_col], False).select(
        F.col(id_col).cast("long").alias(id_col), F.col("_n").alias("n_pieces"), F.col("_sha").alias("pieces_sha256"), F.col("_ok").alias("round_trip"))
