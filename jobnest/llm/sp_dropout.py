"""SentencePiece segmentation with seeded merge-dropout, and its decoding.

A text gets the model's leading blank, blanks become U+2581, and it is cut where no piece of the model crosses: before
runs of blanks and around ASCII characters that no piece joins to others.  In each unit an agenda holds the candidate merges (neighbours whose join is a piece), the best score
first, then the leftmost.  A candidate that comes up is skipped for good when the keyed hash of its place (start, middle,
end) and of the *occurrence* of the unit falls below ``dropout``; else its two symbols become one.  What is left are
pieces, or the bytes of characters that are none.  With ``dropout`` 0 this is the model's own segmentation.

An occurrence is the keyed hash of seed, document id, text and the unit's place in the text, so every word is drawn anew
wherever it stands, reruns agree, and another seed gives other cuts.  What is remembered of a unit is the tree of its
candidates and what each way through it ends in, never a draw: occurrences walk the trees side by side, each with its own
skips, and a way that none has gone before is cut by the agenda.

Decoding joins the pieces' bytes and drops the leading blank: texts come back exactly (a U+2581 in a text goes through
byte pieces).  A null text is null ids, an empty one no ids; repeated rows get equal ids; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import itertools
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from .common import map_batches, memory, mixed, pick

DROPOUT, SEED = 0.1, 29
BLANK = "▁"
#: Stands for a U+2581 of the text itself, which must not become a blank: a lone surrogate, which no text can hold.
_LITERAL = "\ud800"
#: Most nodes of the remembered trees; beyond them all trees are begun anew.
_MEMORY = 3_000_000
#: Longer units are cut one by one and not remembered; shorter ones are cut side by side, so many at a time.
_SHORT, _SIDE = 64, 4096
#: Characters of texts whose units are held at a time (a longer text is held alone).
_GROUP = 1 << 19
_MASK = 2**64 - 1
#: Nodes whose next candidate is not known yet, and nodes where a way ends.
_OPEN, _END = -1, -2
_models: dict[tuple, Segmenter] = {}


@memory
def _forget_models() -> None:
    _models.clear()


class Segmenter:
    """Model tables, and a bounded memory of units' trees."""

    def __init__(self, path: str, dropout: float, seed: int, memory: int = _MEMORY):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.bytes_id = [0] * 256
        self.raw: list[bytes] = []
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            self.raw.append(b"")
            if sp.is_byte(i):
                self.bytes_id[int(piece[3:5], 16)] = i
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.rank[piece], self.id[piece] = -sp.get_score(i), i
                self.raw[i] = piece.replace(BLANK, " ").encode()
        # cuts that no piece crosses: around ASCII characters that are joined to nothing, and before ASCII marks that
        # no piece has behind anything but blanks and other such marks
        pairs = {pair for p in self.id for pair in zip(p, p[1:])}
        joined = {c for pair in pairs for c in pair}
        alone = {c for c in map(chr, range(128)) if c not in joined}
        marks = {c for c in map(chr, range(128)) if c in joined and not c.isalnum()}
        while late := {c for x, c in pairs if c in marks and x != BLANK and x not in marks}:
            marks -= late
        alone, mark = re.escape("".join(sorted(alone))), re.escape("".join(sorted(marks)))
        any_mark = f"[{mark}]" if mark else "(?!)"
        self.unit = re.compile(f"{BLANK}*{any_mark}*[^{BLANK}{alone}{mark}]+|{BLANK}*{any_mark}+|{BLANK}+|.", re.S)
        # symbols by number (pieces and the characters in them), and the joins of two of them, by a sorted key
        symbols = {x: i for i, x in enumerate(dict.fromkeys([*self.id, *(c for p in self.id for c in p)]))}
        joins = sorted((symbols[p[:i]] * len(symbols) + symbols[p[i:]], self.rank[p], symbols[p]) for p in self.id for i in range(1, len(p)) if p[:i] in symbols and p[i:] in symbols)
        self.n_symbols = len(symbols)
        self.join_keys = np.array([k for k, _, _ in joins] + [np.iinfo(np.int64).max], np.int64)
        self.join_ranks = np.array([r for _, r, _ in joins] + [np.inf])
        self.join_to = np.array([t for _, _, t in joins] + [-1], np.int64)
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for x, i in symbols.items():
            if len(x) == 1:
                self.symbol_of[ord(x)] = i
        self.symbol_id = np.array([self.id.get(x, -1) for x in symbols] + [-1], np.int64)
        self.below = int(dropout * 2**64)
        self.seed, self.memory = seed, memory
        self._forget()

    def _forget(self) -> None:
        """Begins all trees anew.  A node has the hash of its candidate, and as its kids the node behind the merge and
        behind it the one behind the skip; where a way ends it has the first place and the number of its ids."""
        self.roots: dict[str, int] = {}
        self.n_nodes = self.n_ids = 0
        self.place, self.kids, self.depth = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int16)
        self.count = np.zeros(1 << 16, np.int32)
        self.ids = np.zeros(1 << 16, np.uint32)

    def _nodes(self, n: int, depth: int) -> int:
        """The first of ``n`` new open nodes."""
        at, self.n_nodes = self.n_nodes, self.n_nodes + n
        if self.n_nodes > len(self.kids):
            for name in ("place", "kids", "depth", "count"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros(max(len(old) // 2, n), old.dtype)]))
        self.kids[at: self.n_nodes], self.depth[at: self.n_nodes] = _OPEN, depth
        return at

    def _end(self, nodes: np.ndarray, ids: list[bytes]) -> None:
        """Ways end at ``nodes`` in these ids."""
        new = np.frombuffer(b"".join(ids), "<u4")
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        if self.n_ids + len(new) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids) // 2, len(new)), np.uint32)])
        self.ids[self.n_ids: self.n_ids + len(new)] = new
        self.kids[nodes], self.place[nodes], self.count[nodes] = _END, self.n_ids + np.cumsum(counts) - counts, counts
        self.n_ids += len(new)

    @classmethod
    def of(cls, *key) -> Segmenter:
        if key not in _models:
            if len(_models) > 2:
                _models.clear()
            _models[key] = cls(*key)
        return _models[key]

    def pieces(self, unit: str, key: int) -> list[str]:
        """The agenda, with the skips of occurrence ``key``: symbols are named by their first character's place."""
        n = len(unit)
        rank = self.rank.get
        agenda = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank(unit[i: i + 2])) is not None]
        if not agenda:
            return list(unit)
        heapq.heapify(agenda)
        end = list(range(1, n + 1))  # 0 where a symbol has been joined to the one before it
        before = list(range(-1, n - 1))
        below = self.below
        pop, push = heapq.heappop, heapq.heappush
        while agenda:
            _, a, b, stop = pop(agenda)
            # stale, if one of the two symbols has grown or gone
            if end[a] != b or end[b] != stop:
                continue
            if below:
                x = (key ^ (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + stop * 0x165667B19E3779F9)) * 0xBF58476D1CE4E5B9 & _MASK
                if (x ^ x >> 31) * 0x94D049BB133111EB & _MASK < below:
                    continue
            end[a], end[b] = stop, 0
            if stop < n:
                before[stop] = a
                r = rank(unit[a: end[stop]])
                if r is not None:
                    push(agenda, (r, a, stop, end[stop]))
            if a:
                left = before[a]
                r = rank(unit[left:stop])
                if r is not None:
                    push(agenda, (r, left, a, stop))
        out, i = [], 0
        while i < n:
            out.append(unit[i: end[i]])
            i = end[i]
        return out

    def _one(self, unit: str, key: int) -> bytes:
        return self._bytes([(self.id.get(piece, -1), piece) for piece in self.pieces(unit, key)])

    def _bytes(self, pieces: list[tuple[int, str]]) -> bytes:
        """Ids of pieces; of those that are none (id -1), of their characters' bytes."""
        out = []
        for i, piece in pieces:
            if i >= 0:
                out.append(i)
            else:
                out += [self.bytes_id[b] for c in piece for b in (BLANK if c == _LITERAL else c).encode()]
        return struct.pack(f"<{len(out)}I", *out)

    def _joins(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and symbol of what two symbols (-1: none) join to; rank inf where that is no piece."""
        keys = left * self.n_symbols + right
        at = np.searchsorted(self.join_keys, keys)
        real = (left >= 0) & (right >= 0) & (self.join_keys[at] == keys)
        return np.where(real, self.join_ranks[at], np.inf), np.where(real, self.join_to[at], -1)

    def _side(self, units: list[str], keys: np.ndarray | int, nodes: np.ndarray | None = None) -> list[bytes]:
        """What ``pieces`` gives, for many short units at once: each step takes every unit's best candidate.

        ``nodes`` are the open nodes that the units have come to; they move to the ways' ends as the trees grow."""
        n, width = len(units), max(map(len, units))
        size = np.array([len(u) for u in units])
        inside = np.arange(width) < size[:, None]
        symbol = np.full((n, width + 1), -1, np.int64)
        symbol[:, :width][inside] = self.symbol_of[np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4")]
        end = np.tile(np.arange(1, width + 2), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))
        alive = inside.copy()
        rank, to = self._joins(symbol[:, :width], symbol[:, 1:])
        keys = np.broadcast_to(np.asarray(keys, np.uint64), n)
        rows = np.arange(n)
        step = 0
        while True:
            a = rank[rows].argmin(axis=1)
            some = rank[rows, a] < np.inf
            rows, a = rows[some], a[some]
            if not len(rows):
                break
            b = end[rows, a]
            stop = end[rows, b]
            rank[rows, a] = np.inf
            r = rows
            if self.below:
                place = self._place(a, b, stop)
                skip = self._skipped(keys[r], place)
                if nodes is not None:
                    new = self.depth[nodes[r]] <= step
                    at = nodes[r[new]]
                    kids = self._nodes(2 * len(at), step + 1) + 2 * np.arange(len(at))
                    self.place[at], self.kids[at] = place[new], kids
                    nodes[r[new]] = kids + skip[new]
                    step += 1
                go = ~skip
                r, a, b, stop = r[go], a[go], b[go], stop[go]
            symbol[r, a] = to[r, a]
            end[r, a] = stop
            rank[r, b] = np.inf
            alive[r, b] = False
            more, left = stop < size[r], a > 0
            before[r[more], stop[more]] = a[more]
            # the new symbol with the one behind it, and the one before with it
            first = np.concatenate([a[more], before[r[left], a[left]]])
            second = np.concatenate([stop[more], a[left]])
            at = np.concatenate([r[more], r[left]])
            rank[at, first], to[at, first] = self._joins(symbol[at, first], symbol[at, second])
        ids = self.symbol_id[symbol[:, :width][alive]]
        last = np.cumsum(alive.sum(axis=1))
        data = ids.astype("<u4").tobytes()
        out = [data[4 * x: 4 * y] for x, y in zip([0, *last[:-1].tolist()], last.tolist())]
        for i in np.unique(np.searchsorted(last, np.flatnonzero(ids < 0), "right")).tolist():
            starts = np.flatnonzero(alive[i])
            out[i] = self._bytes([(int(self.symbol_id[symbol[i, x]]), units[i][x: end[i, x]]) for x in starts.tolist()])
        return out

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, stop: np.ndarray) -> np.ndarray:
        a, b, stop = (x.astype(np.uint64) for x in (a, b, stop))
        return a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F) + stop * np.uint64(0x165667B19E3779F9)

    def _skipped(self, key: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The skips of ``pieces``, for arrays."""
        x = (key ^ place) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        return x < np.uint64(self.below) if self.below <= _MASK else np.ones(len(x), bool)

    def _walk(self, units: list[str], keys: np.ndarray) -> np.ndarray:
        """The nodes where the ways of these occurrences end."""
        long = [i for i, u in enumerate(units) if len(u) > _SHORT]
        for u in set(units) - self.roots.keys():
            if len(u) <= _SHORT:
                self.roots[u] = self._nodes(1, 0)
        node = np.fromiter(map(self.roots.get, units, itertools.repeat(-1)), np.int64, len(units))
        if long:
            node[long] = self._nodes(len(long), 0) + np.arange(len(long))
            self._end(node[long], [self._one(units[i], k) for i, k in zip(long, keys[long].tolist())])
        todo = np.arange(len(units))
        while len(todo):
            live = todo
            while len(live):
                kids = self.kids[node[live]]
                inner = kids >= 0
                live, kids = live[inner], kids[inner]
                node[live] = kids + self._skipped(keys[live], self.place[node[live]])
            todo = todo[self.kids[node[todo]] == _OPEN]
            if not len(todo):
                break
            # one occurrence grows the tree at each open node; the others follow it, or are cut too if they are few
            some = todo[np.unique(node[todo], return_index=True)[1]]
            rest = np.setdiff1d(todo, some) if len(todo) <= _SIDE else todo[:0]
            if len(rest):
                aside = self._nodes(len(rest), np.iinfo(np.int16).max) + np.arange(len(rest))
                node[rest] = aside
                some, todo = np.concatenate([some, rest]), rest[:0]
            some = some[np.argsort([len(units[i]) for i in some.tolist()], kind="stable")]
            for i in range(0, len(some), _SIDE):
                mine = some[i: i + _SIDE]
                ends = node[mine]
                ids = self._side([units[j] for j in mine.tolist()], keys[mine], ends)
                self._end(ends, ids)
                node[mine] = ends
        return node

    def encode_all(self, texts: list[str], doc_keys: list[int]) -> Iterator[np.ndarray]:
        """The ids of each text in turn."""
        first = size = 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= _GROUP or i + 1 == len(texts):
                yield from self._group(texts[first: i + 1], doc_keys[first: i + 1])
                first, size = i + 1, 0

    def _group(self, texts: list[str], doc_keys: list[int]) -> list[np.ndarray]:
        if self.n_nodes > self.memory or self.n_ids > 4 * self.memory:
            self._forget()
        cut = [self.unit.findall(BLANK + t.replace(BLANK, _LITERAL).replace(" ", BLANK)) if t else [] for t in texts]
        n = np.array([len(units) for units in cut])
        ends = np.cumsum(n)
        if not self.below:
            keys = np.zeros(ends[-1], np.uint64)
        else:
            text_keys = np.array([xxhash.xxh3_64_intdigest(t.encode(), self.seed) for t in texts], np.uint64)
            doc = mixed(mixed(np.array(doc_keys, np.uint64), self.seed) ^ text_keys, self.seed)
            keys = mixed(np.repeat(doc, n) + (np.arange(ends[-1]) - np.repeat(ends - n, n)).astype(np.uint64), self.seed)
        node = self._walk([u for units in cut for u in units], keys)
        counts = self.count[node].astype(np.int64)
        stops = np.cumsum(counts)
        ids = self.ids[np.repeat(self.place[node].astype(np.int64) - stops + counts, counts) + np.arange(counts.sum())]
        stops = np.append(0, stops)
        return [ids[x:y] for x, y in zip(stops[ends - n].tolist(), stops[ends].tolist())]

    def encode(self, text: str, doc_key: int) -> np.ndarray:
        return self._group([text], [doc_key])[0]

    def decode(self, ids: np.ndarray) -> str:
        data = b"".join(map(self.raw.__getitem__, ids.tolist()))
        return data[1:].decode() if data else ""


def _key(doc_id: int | None) -> int:
    return 0 if doc_id is None else (doc_id & _MASK)


def encode(docs: DataFrame, model: str, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text)."""

    def run(batch):
        s = Segmenter.of(model, dropout, seed)
        texts = batch.column(1).to_pylist()
        got = s.encode_all([t or "" for t in texts], list(map(_key, batch.column(0).to_pylist())))
        ids = [None if t is None else x.astype(np.int32) for t, x in zip(texts, got)]
        return {"doc_id": batch.column(0), "ids": ids}

    return map_batches(pick(docs, doc_id="long", text="string"), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids)."""

    def run(batch):
        s = Segmenter.of(model, 0.0, 0)
        return {"doc_id": batch.column(0), "text": [None if i is None else s.decode(np.array(i, np.int64)) for i in batch.column(1).to_pylist()]}

    return map_batches(pick(encoded, doc_id="long", ids="array<int>"), run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """Per row of ``docs`` the digests of its ids and of what they decode to: doc_id, n_tokens, ids_crc32 (of the ids as
    little-endian uint32), decoded_sha256, lossless.  A null text counts as empty here."""
    import hashlib

    def run(batch):
        s = Segmenter.of(model, dropout, seed)
        out: dict[str, list] = {"doc_id": batch.column(0), "n_tokens": [], "ids_crc32": [], "decoded_sha256": [], "lossless": []}
        texts = batch.column(1).to_pylist()
        for t, ids in zip(texts, s.encode_all([t or "" for t in texts], list(map(_key, batch.column(0).to_pylist())))):
            back = s.decode(ids)
            out["n_tokens"].append(len(ids))
            out["ids_crc32"].append(zlib.crc32(ids.tobytes()))
            out["decoded_sha256"].append(hashlib.sha256(back.encode()).hexdigest())
            out["lossless"].append(back == (t or ""))
        return out

    return map_batches(pick(docs, doc_id="long", text="string"), run, "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, lossless boolean")
