"""SentencePiece encoding by suffix-array matching, and decoding.

A batch of texts is normalised (blanks become the space mark, one in front), cut into chunks
where a mark follows another character - no piece spans such a place - and its new distinct
chunks are joined into one text. A suffix array over it, sorted by as many characters as the
longest piece has, is searched for every piece, prefix by prefix: the range of suffixes that
begin with the piece are its occurrences. Occurrences are edges of a lattice over positions;
sorted by their start, the longest first, they are relaxed from the start of each chunk.

The models at hand are BPE models, whose result is not the best sum of scores but what merging
in order of rank leaves. Relaxing therefore asks, for an edge, whether its piece may follow the
piece before: a merge across the seam that ranks before the merges that made the two pieces
forbids it. Only one way through a chunk has no forbidden seam, and that is the encoding; dead
ends step back, and no (position, piece before) is tried twice. Chunks with several marks in
front are merged directly, as runs of marks share one score. Unknown characters become byte
pieces.

Null texts are empty; empty texts have no pieces. Ids and texts equal those of the public
library for the same model file. Memory is bounded by ``GROUP_CHARS`` characters of text (or one
longer text) at a time: distinct chunks are indexed ``INDEX_CHARS`` characters at a time, and at
``CACHE_CHUNKS`` encoded chunks the cache keeps only those in use.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_stream, texts_of

#: Where the public model lies on this box; a parameter of every function.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
INDEX_CHARS, CACHE_CHUNKS, LONGEST_CHUNK, GROUP_CHARS = 500_000, 450_000, 2000, 2_000_000
#: Seams that are remembered, and chunks that are no longer worth walking together.
KNOWN_SEAMS, FEW_CHUNKS = 1_000_000, 200
_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Pieces:
    """The pieces of a model file with the tables that encoding and decoding need."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.text = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        plain = [i for i in range(len(self.text)) if not (
            sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.unknown = sp.unk_id()
        self.special = {i for i in range(len(self.text)) if sp.is_control(i)}
        self.byte = {int(self.text[i][3:5], 16): i for i in range(len(self.text)) if sp.is_byte(i)}
        self.value = {i: b for b, i in self.byte.items()}
        self.id = {self.text[i]: i for i in plain}
        self.score = {i: sp.get_score(i) for i in plain}
        self.longest = max(map(len, self.id), default=1)
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("pieces with a space mark inside are not supported")
        #: Merge order: lower goes first.
        order = sorted(plain, key=lambda i: (-self.score[i], i))
        self.rank = {i: r for r, i in enumerate(order)}
        #: The two pieces whose merge made a piece; absent for single characters.
        self.parts: dict[int, tuple[int, int]] = {}
        for i in order:
            if len(self.text[i]) > 1 and MARK * 2 not in self.text[i]:
                whole = self._merge(self.text[i], stop=i)
                if whole:
                    self.parts[i] = whole
        self.merged = {pair: i for i, pair in self.parts.items()}
        self.usable = sorted(i for i in plain if i in self.parts or len(self.text[i]) == 1)
        self.prefixes = PrefixLevels([self.text[i] for i in self.usable])
        self._fits: dict[int, bool] = {}
        #: Pairs of pieces in order, and whether they fit; the first pair never occurs.
        self._seams = np.array([-1], dtype=np.int64), np.array([False])
        #: Chunks and their ids as little-endian 32-bit numbers.
        self.cache: dict[str, bytes] = {}
        #: Texts of ids that stand for themselves; None for bytes, control and unknown ids.
        self.plain = [t if i in self.rank else None for i, t in enumerate(self.text)]
        self.odd = np.array([t is None for t in self.plain])

    def _merge(self, chunk: str, stop: int | None = None):
        """Plain merging of one chunk, best score first, leftmost among equals.

        With ``stop``, the last pair that makes exactly that piece, or None.
        """
        parts: list[str | None] = list(chunk)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, int]] = []

        def offer(i: int, j: int) -> None:
            if 0 <= i and j < n:
                both = self.id.get(parts[i] + parts[j])
                if both is not None:
                    heapq.heappush(heap, (-self.score[both], i, both))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, both = heapq.heappop(heap)
            if parts[i] is None or after[i] >= n or parts[i] + parts[after[i]] != self.text[both]:
                continue
            j = after[i]
            if both == stop and len(self.text[both]) == n:
                return self.id.get(parts[i]), self.id.get(parts[j])
            parts[i], parts[j] = self.text[both], None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        if stop is not None:
            return None
        return [x for p in parts if p is not None for x in self._ids(p)]

    def _ids(self, piece: str) -> list[int]:
        i = self.id.get(piece)
        if i is not None:
            return [i]
        return [self.byte[b] for b in piece.encode("utf-8", "surrogatepass")] if self.byte else [self.unknown]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging leaves the seam between two pieces alone."""
        key = left << 32 | right
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > KNOWN_SEAMS:
                self._fits.clear()
            known = self._fits[key] = self._seam(left, right)
        return known

    def _seam(self, left: int, right: int) -> bool:
        # Undo the later of the two merges step by step. At each step the pieces that touched
        # the seam at that time could have merged; `until` is the rank before which they had to.
        rank, parts = self.rank, self.parts
        until = len(rank)
        gone_left = False
        while True:
            both = self.merged.get((left, right))
            if both is None:
                both = self.id.get(self.text[left] + self.text[right])
            if both is not None and (rank[both] < until or rank[both] == until and gone_left):
                return False
            a, b = parts.get(left), parts.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and rank[left] > rank[right]):
                until, gone_left, left = rank[left], False, a[1]
            elif a is None or rank[right] > rank[left]:
                # The right piece's merge lies after the seam: an equal rank goes to the seam first.
                until, gone_left, right = rank[right], True, b[0]
            else:
                until, gone_left, right = rank[right], True, b[0]

    # -- encoding -----------------------------------------------------------------------------

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        find, get = _CHUNK.findall, self.cache.get
        cut = [find(normalised(t)) for t in texts]
        found = [list(map(get, c)) for c in cut]
        missing = [k for k, f in enumerate(found) if None in f]
        if missing:
            new = dict.fromkeys(c for k in missing for c, f in zip(cut[k], found[k], strict=True) if f is None)
            self._learn(list(new))
            for k in missing:
                found[k] = list(map(get, cut[k]))
        out = [np.frombuffer(b"".join(f), dtype="<i4") for f in found]
        if len(self.cache) >= CACHE_CHUNKS:
            # What was just used stays: frequent words survive every clearing.
            self.cache = {c: f for k in range(len(cut)) for c, f in zip(cut[k], found[k], strict=True)}
            if len(self.cache) >= CACHE_CHUNKS:
                self.cache = {}
        return out

    def _learn(self, chunks: list[str]) -> None:
        group: list[str] = []
        held = 0
        for c in chunks:
            if c[1:2] == MARK or len(c) > LONGEST_CHUNK:
                self.cache[c] = _packed(self._merge(c))
                continue
            group.append(c)
            held += len(c) + 1
            if held >= INDEX_CHARS:
                self._match(group)
                group, held = [], 0
        if group:
            self._match(group)

    def _match(self, chunks: list[str]) -> None:
        """Encode distinct chunks through one suffix array."""
        joined = "\0".join(chunks) + "\0"
        # Character codes; chunk ends are 0 and sort first, so no piece reaches over one.
        data = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64) + 1
        lengths = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        ends = np.cumsum(lengths + 1) - 1
        data[ends] = 0
        order = suffix_array(data, self.longest)
        starts, sizes, which = occurrences(data, order, self.prefixes)
        sort = np.argsort(starts * (self.longest + 1) - sizes)  # by start, the longest first; no two are equal
        starts, sizes = starts[sort], sizes[sort]
        ids = np.asarray(self.usable, dtype=np.int64)[which[sort]]
        first = np.searchsorted(starts, np.arange(len(data) + 1))
        self._relax(chunks, ends, first, sizes, ids)

    def _relax(self, chunks: list[str], ends: np.ndarray, first: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Walk all chunks along their edges at once, an edge a round; ``first[p]`` is the first edge that starts at ``p``.

        From a dead end a chunk goes back to where its last piece began, for the next edge there. Chunks
        with unknown characters, and the last few that still walk, are walked one by one from their start.
        """
        begins = np.concatenate(([0], ends[:-1] + 1))
        # By place: the edge taken there, and where the piece that led there began.
        taken, came = np.zeros(len(first), dtype=np.int64), np.zeros(len(first), dtype=np.int64)
        live, alone = np.arange(len(chunks)), []
        at, edge, before = begins.copy(), first[begins], np.full(len(chunks), -1, dtype=np.int64)
        while len(live) > FEW_CHUNKS:
            stop = first[at + 1]
            back = np.nonzero(edge == stop)[0]
            if len(back):
                lost = (first[at[back]] == stop[back]) | (at[back] == begins[live[back]])
                here = np.where(lost, at[back], came[at[back]])
                at[back], edge[back] = here, taken[here] + 1
                before[back] = np.where(here == begins[live[back]], -1, ids[taken[came[here]]])
                if lost.any():
                    alone.append(live[back[lost]])
                    go = np.ones(len(live), dtype=bool)
                    go[back[lost]] = False
                    live, at, edge, before = live[go], at[go], edge[go], before[go]
            tries = np.nonzero(edge < first[at + 1])[0]
            piece, last = ids[edge[tries]], before[tries]
            ok = last < 0
            seams = np.nonzero(~ok)[0]
            ok[seams] = self._fitting(last[seams] << 32 | piece[seams])
            edge[tries[~ok]] += 1
            step = tries[ok]
            place = at[step]
            taken[place] = edge[step]
            at[step] += sizes[edge[step]]
            came[at[step]] = place
            before[step] = piece[ok]
            edge[step] = first[at[step]]
            go = at < ends[live]
            if not go.all():
                live, at, edge, before = live[go], at[go], edge[go], before[go]
        again = set(np.concatenate([*alone, live]).tolist())
        # Read back from the ends.
        which, pieces = [], []
        live = np.setdiff1d(np.arange(len(chunks)), np.fromiter(again, dtype=np.int64, count=len(again)))
        at = ends[live]
        while len(live):
            at = came[at]
            which.append(live)
            pieces.append(ids[taken[at]])
            go = at > begins[live]
            live, at = live[go], at[go]
        packed, upto = b"", [0] * len(chunks)
        if which:
            which, pieces = np.concatenate(which[::-1]), np.concatenate(pieces[::-1])
            packed = pieces[np.argsort(which, kind="stable")].astype("<i4").tobytes()
            upto = (4 * np.cumsum(np.bincount(which, minlength=len(chunks)))).tolist()
        begin = 0
        for k, (chunk, end) in enumerate(zip(chunks, upto, strict=True)):
            self.cache[chunk] = self._walk(chunk, int(begins[k]), first, sizes, ids) if k in again else packed[begin:end]
            begin = end

    def _fitting(self, keys: np.ndarray) -> np.ndarray:
        """``fits`` for pairs of pieces, ``left << 32 | right``; what was asked before is kept in order."""
        known, answers = self._seams
        place = np.searchsorted(known, keys)
        new = np.unique(keys[known[np.minimum(place, len(known) - 1)] != keys])
        if len(new):
            if len(known) > KNOWN_SEAMS:
                known, answers = known[:1], answers[:1]
                new = np.unique(keys)
            found = np.fromiter((self._seam(k >> 32, k & 0xFFFFFFFF) for k in new.tolist()), dtype=bool, count=len(new))
            where = np.searchsorted(known, new)
            known, answers = self._seams = np.insert(known, where, new), np.insert(answers, where, found)
            place = np.searchsorted(known, keys)
        return answers[place]

    def _walk(self, chunk: str, begin: int, first: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> bytes:
        """One chunk along its edges, stepping back from dead ends; unknown characters merge with nothing."""
        end, low = len(chunk), int(first[begin])
        first = (first[begin:begin + end + 1] - low).tolist()
        sizes, ids = sizes[low:low + first[-1]].tolist(), ids[low:low + first[-1]].tolist()
        at, before, found, tried = 0, -1, [], set()
        edge = 0
        while at < end:
            stop = first[at + 1]
            if edge == stop and edge == first[at]:
                # No piece starts here.
                found.append((at, edge, before))
                at, before = at + 1, -1
                edge = first[at]
                continue
            while edge < stop and not ((before < 0 or self.fits(before, ids[edge])) and (at + sizes[edge], ids[edge]) not in tried):
                edge += 1
            if edge < stop:
                found.append((at, edge, before))
                at, before = at + sizes[edge], ids[edge]
                edge = first[at]
            else:
                # A dead end: what led here leads nowhere.
                tried.add((at, before))
                at, edge, before = found.pop()
                edge += 1
        return _packed([i for p, e, _ in found for i in ([ids[e]] if e < first[p + 1] else self._ids(chunk[p]))])

    # -- decoding -----------------------------------------------------------------------------

    def decode(self, ids) -> str:
        """The text; bytes that are no UTF-8 become replacement characters, control ids vanish."""
        ids = np.asarray(ids, dtype=np.int64)
        if not self.odd[ids].any():
            return "".join(map(self.plain.__getitem__, ids.tolist())).removeprefix(MARK).replace(MARK, " ")
        parts: list[str] = []
        held = bytearray()

        def flush() -> None:
            if held:
                parts.append(held.decode("utf-8", "replace"))
                held.clear()

        codes, at = ids.tolist(), 0
        for o in [*np.nonzero(self.odd[ids])[0].tolist(), len(codes)]:
            if o > at:
                flush()
                parts += map(self.plain.__getitem__, codes[at:o])
            at = o + 1
            if o == len(codes):
                break
            i = codes[o]
            if i in self.value:
                held.append(self.value[i])
                continue
            flush()
            if i not in self.special:
                parts.append(" ⁇ " if i == self.unknown else self.text[i])
        flush()
        return "".join(parts).removeprefix(MARK).replace(MARK, " ")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}i", *ids)


class PrefixLevels:
    """The distinct prefixes of pieces by length: each one's parent and last character."""

    def __init__(self, pieces: list[str]) -> None:
        known: dict[str, int] = {"": 0}
        parents: list[list[int]] = []
        chars: list[list[int]] = []
        at = [0]
        self.node = []
        for depth in range(max(map(len, pieces), default=0)):
            level: dict[str, int] = {}
            parents.append([])
            chars.append([])
            for p in pieces:
                if len(p) > depth and p[:depth + 1] not in level:
                    level[p[:depth + 1]] = len(level)
                    parents[-1].append(known[p[:depth]])
                    chars[-1].append(ord(p[depth]) + 1)
            known = level
            at.append(at[-1] + len(level))
            self.node.append({k: at[-2] + v for k, v in level.items()})
        self.levels = [(np.array(a, dtype=np.int64), np.array(c, dtype=np.int64)) for a, c in zip(parents, chars, strict=True)]
        #: Place of every piece among all prefixes, level after level.
        self.place = np.array([self.node[len(p) - 1][p] for p in pieces], dtype=np.int64)
        self.sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        del self.node


def normalised(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Starts of suffixes, sorted by their first ``depth`` or more characters (prefix doubling)."""
    n = len(data)
    rank = np.unique(data, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank)
    step = 1
    while step < depth:
        key = rank * (n + 1)
        key[:n - step] += rank[step:] + 1
        order = np.argsort(key)
        sorted_key = key[order]
        fresh = np.empty(n, dtype=np.int64)
        fresh[order] = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
        rank, step = fresh, step * 2
        if rank[order[-1]] == n - 1:
            break
    return order


def occurrences(data: np.ndarray, order: np.ndarray, prefixes: PrefixLevels) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All places of all pieces: ``starts, sizes, piece numbers``; binary search of each in the suffix array."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(len(prefixes.levels), dtype=data.dtype)))
    low, high = np.zeros(1, dtype=np.int64), np.full(1, n, dtype=np.int64)
    lows, highs = [], []
    for depth, (parent, char) in enumerate(prefixes.levels):
        # Within the range of a prefix the characters that follow it ascend.
        low, high = low[parent], high[parent]
        live = np.nonzero(low < high)[0]
        for right in (False, True):
            lo, hi, want = low[live], high[live], char[live]
            while (open_ := lo < hi).any():
                mid = (lo + hi) >> 1
                seen = padded[order[np.minimum(mid, n - 1)] + depth]
                go = open_ & ((seen <= want) if right else (seen < want))
                hi = np.where(open_ & ~go, mid, hi)
                lo = np.where(go, mid + 1, lo)
            if right:
                high[live] = lo
            else:
                begins = lo
        low[live] = begins
        lows.append(low)
        highs.append(high)
    low, high = np.concatenate(lows)[prefixes.place], np.concatenate(highs)[prefixes.place]
    counts = np.maximum(0, high - low)
    hit = np.nonzero(counts)[0]
    counts = counts[hit]
    offsets = np.repeat(low[hit] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
    return order[offsets], np.repeat(prefixes.sizes[hit], counts), np.repeat(hit, counts)


_LOADED: dict[str, Pieces] = {}


def pieces_of(model: bytes) -> Pieces:
    """One table per worker process and model."""
    key = hashlib.sha1(model).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Pieces(model)
    return _LOADED[key]


def encode_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """One row per document: ``doc_id, n_pieces, ids, text_sha256, decoded_sha256, round_trip``.

    Digests are of the text and of the text decoded from ``ids``.
    """
    with open(model, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def finished(batch: pd.DataFrame) -> pd.DataFrame:
        codec = pieces_of(shared.value)
        texts = batch["text"].tolist()
        ids = codec.encode_texts(texts)
        back = [codec.decode(x) for x in ids]
        digest = lambda t: hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()
        return pd.DataFrame({
            "doc_id": batch["doc_id"], "n_pieces": [len(x) for x in ids], "ids": ids,
            "text_sha256": [digest(t) for t in texts], "decoded_sha256": [digest(t) for t in back],
            "round_trip": [a == b for a, b in zip(texts, back, strict=True)]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, chars = [], 0
        for batch in batches:
            held.append(batch)
            chars += int(batch["text"].str.len().sum())
            if chars >= GROUP_CHARS:
                yield finished(pd.concat(held, ignore_index=True))
                held, chars = [], 0
        if held:
            yield finished(pd.concat(held, ignore_index=True))

    return map_stream(texts_of(docs), run, (
        "doc_id long, n_pieces long, ids array<int>, text_sha256 string, decoded_sha256 string, round_trip boolean"))
