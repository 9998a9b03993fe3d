"""SentencePiece encoding and decoding for merge-type vocabularies, checked against the library.

A text becomes symbols; an agenda of adjacent pairs, ordered by the score of the merged piece and then from the
left, merges until no pair is a piece. Since no piece crosses certain places (a space mark after another
character, a character that is in no longer piece), the text is cut there and each cut's result is memoised.
Results for odd rows: a null text counts as empty (begin and end ids only); repeated rows repeat; an empty table
gives an empty one; a doc_id may be null; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import re
import struct

import numpy as np
from pyspark.sql import DataFrame

from tallyframe.llm.common import arrow_map, kind_of

SPACE = "▁"
#: Piece types and the merge model's number in the public model format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
#: Cuts in each of a worker's two memos; when the newer is full it becomes the older, and the older goes.
MEMO = 800_000
#: Cuts up to this length are merged side by side.
SIDE_BY_SIDE = 40
NEVER = 1 << 40


def _fields(data: bytes):
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            value, at = data[at:at + size], at + size
        yield key >> 3, value


class Vocabulary:
    """Pieces, scores and types of a model file; rejects models that this codec does not implement."""

    def __init__(self, model: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.types: list[int] = []
        trainer: dict = {}
        normalizer: dict = {}
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
                self.types.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        self.dummy_prefix = bool(normalizer.get(3, 1))
        if trainer.get(3, 1) != BPE or trainer.get(24, 0):
            raise ValueError("the model is not a merge-type vocabulary with leading space marks")
        if normalizer.get(2, b"") or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("the model normalises texts; only the identity with escaped spaces is implemented")
        if USER in self.types or UNUSED in self.types:
            raise ValueError("user-defined or unused pieces are not implemented")
        order = {x: r for r, x in enumerate(sorted(set(self.scores), reverse=True))}
        self.ranks = {p: order[x] for p, x, t in zip(self.pieces, self.scores, self.types) if t == NORMAL}
        self.ids = {p: i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == NORMAL}
        self.unknown = self.types.index(UNKNOWN)
        self.byte_ids = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(self.pieces, self.types)) if t == BYTE}
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte fallback")
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        self.begin, self.end = self.pieces.index("<s>"), self.pieces.index("</s>")


class Codec:
    def __init__(self, model: bytes):
        self.vocabulary = v = Vocabulary(model)
        longer = [p for p in v.ids if len(p) > 1]
        inside = set().union(*longer) if longer else set()
        alone = "".join(c for c in "\n\t\r" if c not in inside)
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in longer):
            self.cuts = re.compile(r".+", re.DOTALL)
        else:
            one = f"[{re.escape(alone)}]|" if alone else ""
            self.cuts = re.compile(f"{one}{SPACE}+[^{SPACE}{re.escape(alone)}]*|[^{SPACE}{re.escape(alone)}]+")
        self._pair_table()
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.odd: dict[str, str] = {}  # remembered cuts that do not decode to themselves
        self.wrong: set[str] = set()  # remembered cuts that the library encodes or decodes otherwise

    def merge(self, text: str) -> list[int]:
        """Ids of one cut: pairs leave the agenda by score, then from the left; outdated ones are passed over."""
        v, rank, symbols = self.vocabulary, self.vocabulary.ranks.get, list(text)
        n = len(symbols)
        agenda = [(r, i) for i in range(n - 1) if (r := rank(symbols[i] + symbols[i + 1])) is not None]
        heapq.heapify(agenda)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        while agenda:
            r, i = heapq.heappop(agenda)
            j = after[i]
            if j >= n or not symbols[i]:
                continue
            merged = symbols[i] + symbols[j]
            if rank(merged) != r:
                continue
            symbols[i], symbols[j] = merged, ""
            after[i] = right = after[j]
            left = before[i]
            if right < n:
                before[right] = i
                if (r := rank(merged + symbols[right])) is not None:
                    heapq.heappush(agenda, (r, i))
            if left >= 0 and (r := rank(symbols[left] + merged)) is not None:
                heapq.heappush(agenda, (r, left))
        ids: list[int] = []
        for s in symbols:
            if s:
                piece = v.ids.get(s)
                ids.extend([piece] if piece is not None else (v.byte_ids[b] for b in s.encode()))
        return ids

    def _pair_table(self) -> None:
        """Numbers for all symbols, and sorted keys of the pairs that merge, with rank and result."""
        v = self.vocabulary
        names = sorted(set(v.ids) | set().union(*v.ids)) if v.ids else []
        self.count = len(names) + 1  # number 0: a character that is in no piece
        number = {n: i + 1 for i, n in enumerate(names)}
        self.of_char = np.zeros(0x110000, np.int32)
        for n, i in number.items():
            if len(n) == 1:
                self.of_char[ord(n)] = i
        self.piece_of = np.array([-1, *(v.ids.get(n, -1) for n in names)], np.int64)
        pairs = sorted(
            (number[p[:at]] * self.count + number[p[at:]], v.ranks[p], number[p])
            for p in v.ids for at in range(1, len(p)) if p[:at] in number and p[at:] in number
        )
        keys, ranks, results = (np.array(c, np.int64) for c in zip(*pairs or [(0, NEVER, 0)]))
        # An open-addressing table: a key lies at its slot or, while that is taken, at the next.
        self.bits = max(10, int(len(keys)).bit_length() + 2)
        size = 1 << self.bits
        self.keys, self.rank_of, self.result_of = (np.full(size, x, np.int64) for x in (-1, NEVER, 0))
        waiting, slot = np.arange(len(keys)), self._slot(keys)
        while len(waiting):
            _, first = np.unique(slot[waiting], return_index=True)
            took = waiting[first][self.keys[slot[waiting[first]]] < 0]
            self.keys[slot[took]], self.rank_of[slot[took]], self.result_of[slot[took]] = keys[took], ranks[took], results[took]
            waiting = waiting[self.keys[slot[waiting]] != keys[waiting]]
            slot[waiting] = (slot[waiting] + 1) % size

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slots in the pair table, ranks) of pairs; the rank is NEVER where a pair does not merge."""
        keys = left.astype(np.int64) * self.count + right
        at = self._slot(keys)
        found = self.keys[at]
        wrong = np.flatnonzero((found != keys) & (found >= 0)) if keys.ndim == 1 else np.nonzero((found != keys) & (found >= 0))
        while np.size(wrong[0] if keys.ndim > 1 else wrong):
            at[wrong] = (at[wrong] + 1) % len(self.keys)
            found = self.keys[at[wrong]]
            again = (found != keys[wrong]) & (found >= 0)
            wrong = wrong[again] if keys.ndim == 1 else tuple(w[again] for w in wrong)
        return at, np.where(self.keys[at] == keys, self.rank_of[at], NEVER)

    def merge_alike(self, cuts: list[str]) -> list[bytes | None]:
        """Encoded ids of cuts of one length. Each row of ``agenda`` is a cut's agenda by place; all cuts take
        their best pair at once, so they stay of one length till they are done. None: the cut needs bytes."""
        n = len(cuts[0])
        out: list[bytes | None] = [None] * len(cuts)
        symbols = self.of_char[np.array(cuts, f"<U{n}").view("<u4").reshape(len(cuts), n)]
        agenda = self._look(symbols[:, :-1], symbols[:, 1:])[1]
        rows = np.arange(len(cuts))
        while len(rows):
            width = symbols.shape[1]
            place = agenda.argmin(axis=1) if width > 1 else np.zeros(len(rows), int)
            each = np.arange(len(rows))
            more = agenda[each, place] < NEVER if width > 1 else np.zeros(len(rows), bool)
            done = ~more
            if done.any():
                ids = self.piece_of[symbols[done]]
                whole = (ids >= 0).all(axis=1)
                data = ids.astype("<u4").tobytes()
                for k, (row, good) in enumerate(zip(rows[done].tolist(), whole.tolist())):
                    if good:
                        out[row] = data[4 * width * k:4 * width * (k + 1)]
                rows, symbols, agenda, place = rows[more], symbols[more], agenda[more], place[more]
                if not len(rows):
                    break
                each = np.arange(len(rows))
            merged = self.result_of[self._look(symbols[each, place], symbols[each, place + 1])[0]]
            columns = np.arange(width - 1)
            symbols = np.take_along_axis(symbols, columns + (columns > place[:, None]), axis=1)
            symbols[each, place] = merged
            columns = columns[:-1]
            agenda = np.take_along_axis(agenda, columns + (columns >= place[:, None]), axis=1)
            for x, y in ((place - 1, place), (place, place + 1)):
                there = (x >= 0) & (y < width - 1)
                a, b = each[there], x[there]
                agenda[a, b] = self._look(symbols[a, b], symbols[a, b + 1])[1]
        return out

    def merge_short(self, cuts: list[str]) -> list[bytes | None]:
        """Encoded ids of the cuts that are short and need no bytes, merged side by side with those as long."""
        out: list[bytes | None] = [None] * len(cuts)
        by_length: dict[int, list[int]] = {}
        for i, cut in enumerate(cuts):
            by_length.setdefault(len(cut), []).append(i)
        for length, own in by_length.items():
            if length <= SIDE_BY_SIDE and len(own) > 1:
                for i, ids in zip(own, self.merge_alike([cuts[i] for i in own])):
                    out[i] = ids
        return out

    def pieces_text(self, ids: list[int]) -> str:
        """The text of ids without the treatment of the first space: byte runs are decoded together."""
        v, out, run = self.vocabulary, [], bytearray()
        for i in [*ids, -1]:
            if i in v.bytes_of:
                run.append(v.bytes_of[i])
                continue
            if run:
                out.append(run.decode(errors="replace"))
                run.clear()
            if i >= 0 and v.types[i] != CONTROL:
                out.append(" ⁇ " if i == v.unknown else v.pieces[i].replace(SPACE, " "))
        return "".join(out)

    def learn(self, cuts: set[str], library) -> None:
        """Remember the ids of ``cuts``; each is checked against the library, alone or after a line feed."""
        new = []
        for cut in cuts:
            known = self.older.get(cut)
            if known is None:
                new.append(cut)
            else:
                self.newer[cut] = known
        own = self.merge_short(new)
        for i in [i for i, ids in enumerate(own) if ids is None]:
            ids = self.merge(new[i])
            own[i] = np.array(ids, "<u4").tobytes()
            text = self.pieces_text(ids)
            if text != new[i].replace(SPACE, " "):
                self.odd[new[i]] = text
        self.newer.update(zip(new, own))
        # The library adds a space mark itself; cuts without one go to it after a line feed, whose ids are cut off.
        marked = [self.vocabulary.dummy_prefix and len(cut) > 1 and cut[0] == SPACE for cut in new]
        for kind, lead in ((True, 0), (False, 0 if not self.vocabulary.dummy_prefix else 1)):
            places = [i for i, m in enumerate(marked) if m == kind] if library is not None else []
            for start in range(0, len(places), 4096):
                part = places[start:start + 4096]
                theirs = library.encode([new[i][1:] if kind else "\n" + new[i] for i in part], num_threads=1)
                if not kind:
                    theirs = [ids[lead + 1:] for ids in theirs]
                flat = np.fromiter(itertools.chain.from_iterable(theirs), "<u4").tobytes()
                mine = [own[i] for i in part]
                if flat != b"".join(mine) or [4 * len(ids) for ids in theirs] != list(map(len, mine)):
                    self.wrong.update(new[i] for i, ids in zip(part, theirs) if struct.pack(f"<{len(ids)}I", *ids) != own[i])

    def encode_batch(self, texts: list[str], library=None) -> list[tuple[bytes, str, bool]]:
        """Of each text: ids with begin and end as little-endian 32-bit integers, the text that they decode to,
        and whether the library agrees on every cut."""
        v = self.vocabulary
        begin, end = (np.array([i], "<u4").tobytes() for i in (v.begin, v.end))
        mark = SPACE if v.dummy_prefix else ""
        marked = [mark + t.replace(" ", SPACE) if t else "" for t in texts]
        cuts = list(map(self.cuts.findall, marked))
        needed = set().union(*cuts)
        if len(self.newer) + len(needed) > MEMO:
            self.older, self.newer = self.newer, {}
            self.odd = {c: t for c, t in self.odd.items() if c in self.older}
            self.wrong &= self.older.keys()
        self.learn(needed - self.newer.keys(), library)
        known = {c: self.newer[c] for c in needed}
        out = []
        for text, own in zip(marked, cuts):
            ids = b"".join((begin, *map(known.__getitem__, own), end))
            if self.odd and not self.odd.keys().isdisjoint(own):
                decoded = "".join([self.odd.get(c) or c.replace(SPACE, " ") for c in own])
            else:
                decoded = text.replace(SPACE, " ")
            if v.dummy_prefix and decoded.startswith(" "):
                decoded = decoded[1:]
            out.append((ids, decoded, not self.wrong or self.wrong.isdisjoint(own)))
        return out

    def decode(self, ids: list[int]) -> str:
        text = self.pieces_text(ids)
        return text[1:] if self.vocabulary.dummy_prefix and text.startswith(" ") else text


@functools.lru_cache(maxsize=2)
def _tools(model: bytes):
    """The codec and the library, kept with their memos while the Python worker lives."""
    import sentencepiece

    return Codec(model), sentencepiece.SentencePieceProcessor(model_proto=model)


def encode_documents(docs: DataFrame, model: bytes, texts: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, library_agrees; with ``texts`` also ids and decoded.

    ``library_agrees``: the sentencepiece library, run in the Arrow batch that first held it, gives the same ids
    for every cut of the text.
    """

    def run(cols: dict[str, list]) -> dict[str, list]:
        own = (tools := _tools(model))[0].encode_batch([t or "" for t in cols["text"]], tools[1])
        out = {
            "doc_id": cols["doc_id"], "n_tokens": [len(b) // 4 for b, *_ in own],
            "ids_sha256": [hashlib.sha256(b).hexdigest() for b, *_ in own],
            "decoded_sha256": [hashlib.sha256(d.encode()).hexdigest() for _, d, _ in own],
            "library_agrees": [same for *_, same in own],
        }
        if texts:
            out |= {"ids": [np.frombuffer(b, "<u4").astype(int).tolist() for b, *_ in own], "decoded": [d for _, d, _ in own]}
        return out

    schema = f"doc_id {kind_of(docs, 'doc_id')}, n_tokens long, ids_sha256 string, decoded_sha256 string, library_agrees boolean"
    return arrow_map(docs.select("doc_id", "text"), run, schema + (", ids array<int>, decoded string" if texts else ""), rows=512)
