"""Byte-level BPE encoding by a lazily determinised transducer, and streaming decoding.

The merges become a nondeterministic transducer: a path has emitted some tokens
and stands in the trie of token bytes.  On reaching a token it may emit it when
the token, after the one before, is what the merges make of both (a property of
the pair, found once and kept).  A chain of such pairs is the merges' own
result, so each prefix of the input has exactly one chain that ends there, and
a set of live paths holds at most one per open token start.  Sets of live paths
are the states of the deterministic transducer; they and their transitions are
made when first met, with the token of the path that may end there.  Tokens are
emitted where all live paths agree, within one longest token, and at the end of a piece.

Texts are cut at spaces that follow and precede other characters, where the
split pattern always cuts as well, and the transducer's output of such a cut is
kept in a bounded memo.

Decoding joins token bytes; :class:`Utf8Stream` turns a stream of byte chunks
into text by a state machine that keeps only an unfinished character.

Defined results: a null or empty text has no ids (both digests are those of the
empty string); texts are encoded whole, special-token strings as ordinary text;
repeated rows are encoded alike; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from tallyframe.llm.common import ship

#: Bounds of the memo of cuts and of the transducer's states; beyond them they start anew.
MEMO_SIZE, MEMO_CHARS, MAX_STATES = 1_200_000, 48, 150_000
PIECE_MEMO_SIZE = 500_000
#: From so many bytes of a piece on, agreed tokens are emitted before it ends.
SETTLE = 64


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 bytes and rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.size = {r: len(t) for t, r in ranks.items()}
        #: The trie of token bytes: (node * 256 + byte) -> node; which nodes go on, and the token that ends at one.
        self.child: dict[int, int] = {}
        self.open = [False]
        self.token = [-1]
        for piece, rank in ranks.items():
            node = 0
            for b in piece:
                self.open[node] = True
                nxt = self.child.get(node << 8 | b)
                if nxt is None:
                    nxt = self.child[node << 8 | b] = len(self.token)
                    self.open.append(False)
                    self.token.append(-1)
                node = nxt
            self.token[node] = rank
        self.pairs: dict[tuple[int, int], bool] = {}
        self._reset()

    def _reset(self) -> None:
        start = ((-1, 0),)
        self.states = [start]
        self.index = {start: 0}
        #: Per state: byte -> (the next state's row, token); under -1 the state's own number.
        self.rows: list[dict[int, tuple[dict, int]]] = [{-1: 0}]

    def merge(self, piece: bytes) -> list[int]:
        """The merges applied by rank, leftmost first; used on single tokens and pairs when compiling."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def follows(self, last: int, tok: int) -> bool:
        """Whether the merges leave ``last`` and ``tok`` apart (``last`` -1: leave ``tok`` whole)."""
        ok = self.pairs.get((last, tok))
        if ok is None:
            want = [tok] if last < 0 else [last, tok]
            ok = self.pairs[last, tok] = self.merge(b"".join(self.tokens[t] for t in want)) == want
        return ok

    def _step(self, row: dict, byte: int) -> tuple[dict, int]:
        """The next state's row, and the token of the one path that may end here (-1: none)."""
        paths, ended, child_of, opened, token = [], -1, self.child.get, self.open, self.token
        for last, node in self.states[row[-1]]:
            child = child_of(node << 8 | byte)
            if child is None:
                continue
            if opened[child]:
                paths.append((last, child))
            tok = token[child]
            if tok >= 0 and self.follows(-1, tok) and (last < 0 or self.follows(last, tok)):
                ended = tok
        if ended >= 0:
            paths.append((ended, 0))
        key = tuple(paths)
        to = self.index.get(key)
        if to is None:
            to = self.index[key] = len(self.states)
            self.states.append(key)
            self.rows.append({-1: to})
        made = row[byte] = (self.rows[to], ended)
        return made

    def _settled(self, ends: list[int], stop: int) -> list[int]:
        """The tokens of the one path that ends at ``stop``."""
        out, size = [], self.size
        while stop:
            tok = ends[stop - 1]
            out.append(tok)
            stop -= size[tok]
        out.reverse()
        return out

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one piece of the split pattern; a piece that is a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > MAX_STATES:
            self._reset()
        out: list[int] = []
        ends: list[int] = []
        row, add = self.rows[0], ends.append
        if len(piece) < SETTLE:
            for b in piece:
                try:
                    row, ended = row[b]
                except KeyError:
                    row, ended = self._step(row, b)
                add(ended)
            return self._settled(ends, len(ends))
        for b in piece:
            try:
                row, ended = row[b]
            except KeyError:
                row, ended = self._step(row, b)
            add(ended)
            if ended >= 0 and len(ends) >= SETTLE and len(self.states[row[-1]]) == 1:  # all live paths agree so far
                out += self._settled(ends, len(ends))
                ends.clear()
        return out + self._settled(ends, len(ends))


class Cuts:
    """Ids of whole texts from an encoder of cuts: ``text`` gives them as little-endian uint32 bytes."""

    _open = re.compile(r" (?!\S)")
    _cuts = re.compile(r" (?=\S)")

    def __init__(self, encode: Callable[[str], Iterable[int]], spaced: np.ndarray | None = None):
        """``spaced``: by id, whether a token begins with a space; with it, new cuts are encoded many at a time."""
        self.encode, self.spaced = encode, spaced
        self.memo: dict[str, bytes] = {}

    def _learn(self, parts: list[str]) -> None:
        """Encodes new cuts end to end; every token that begins with a space begins a cut, as they have no other space."""
        new = [p for p in dict.fromkeys(parts) if p not in self.memo and 0 < len(p) <= MEMO_CHARS and " " not in p]
        for k in range(0, len(new), 1000):
            some = new[k:k + 1000]
            ids = np.asarray(self.encode("".join(" " + p for p in some)), "<u4")
            for p, own in zip(some, np.split(ids, np.flatnonzero(self.spaced[ids])[1:])):
                self.memo[p] = own.tobytes()

    def _cut(self, cut: str) -> bytes:
        return np.asarray(self.encode(cut), "<u4").tobytes()

    def text(self, text: str) -> bytes:
        """The split pattern begins a piece at every space before a character that isn't white space,
        and takes white space before such a space alike whether the text ends there or not: so each cut
        is encoded alone.  A plain split does where no other space occurs."""
        if not text:
            return b""
        memo, out = self.memo, []
        if len(memo) > MEMO_SIZE:
            memo.clear()
        head, *rest = self._cuts.split(text) if self._open.search(text) else text.split(" ")
        if head:
            out.append(self._cut(head))
        try:
            out += map(memo.__getitem__, rest)
            return b"".join(out)
        except KeyError:
            del out[1 if head else 0:]
        if self.spaced is not None:
            self._learn(rest)
        for part in rest:
            ids = memo.get(part)
            if ids is None:
                ids = self._cut(" " + part)
                if len(part) <= MEMO_CHARS:
                    memo[part] = ids
            out.append(ids)
        return b"".join(out)


class Utf8Stream:
    """Incremental UTF-8: ``feed`` chunks cut anywhere, get the text that is complete; ``end`` closes the stream.

    The state is how many continuation bytes are due, the range the next one
    must lie in, and the bytes of the unfinished character; ill-formed input
    raises UnicodeDecodeError.
    """

    def __init__(self):
        self.open = b""

    @staticmethod
    def _due(lead: int) -> tuple[int, int, int]:
        """Continuation bytes after a lead byte and the range of the first of them; 0 for no lead byte."""
        if 0xC2 <= lead <= 0xDF:
            return 1, 0x80, 0xBF
        if 0xE0 <= lead <= 0xEF:
            return 2, 0xA0 if lead == 0xE0 else 0x80, 0x9F if lead == 0xED else 0xBF
        if 0xF0 <= lead <= 0xF4:
            return 3, 0x90 if lead == 0xF0 else 0x80, 0x8F if lead == 0xF4 else 0xBF
        return 0, 0, 0

    def _unfinished(self, data: bytes) -> int:
        """Length of a well-begun character at the end of ``data`` that needs more bytes."""
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if 0x80 <= b <= 0xBF:
                continue
            due, low, high = self._due(b)
            if due < back or back > 1 and not low <= data[-back + 1] <= high:
                return 0
            return back
        return 0

    def feed(self, chunk: bytes) -> str:
        data = self.open + chunk
        n = self._unfinished(data)
        done, self.open = (data[:-n], data[-n:]) if n else (data, b"")
        return done.decode("utf-8")

    def end(self) -> None:
        if self.open:
            raise UnicodeDecodeError("utf-8", self.open, 0, len(self.open), "unfinished character")


class Codec:
    """Encoder and decoder of one rank file and split pattern."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.transducer = Transducer(ranks)
        self.split = regex.compile(pattern)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.bytes_of[r] = t
        self.decimal = [str(i) for i in range(len(self.bytes_of))]
        self.cuts = Cuts(self._pieces)
        self.pieces: dict[str, list[int]] = {}

    def _pieces(self, cut: str) -> list[int]:
        out: list[int] = []
        memo = self.pieces
        for piece in self.split.findall(cut):
            ids = memo.get(piece)
            if ids is None:
                ids = self.transducer.encode(piece.encode())
                if len(piece) <= MEMO_CHARS:
                    if len(memo) > PIECE_MEMO_SIZE:
                        memo.clear()
                    memo[piece] = ids
            out += ids
        return out

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.cuts.text(text), "<u4")

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode_stream(self, ids: np.ndarray, chunk: int = 4096) -> Iterator[str]:
        """The text, chunk of ids by chunk, whatever characters the cuts between tokens split."""
        stream = Utf8Stream()
        for at in range(0, len(ids), chunk):
            yield stream.feed(self.decode_bytes(ids[at:at + chunk].tolist()))
        stream.end()


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec a worker process; the vocabulary file is read where it lies on the executor."""
    key = (path, pattern)
    if key not in _codecs:
        _codecs[key] = Codec(path, pattern)
    return _codecs[key]


def encode_documents(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked, the ids.

    ``ids_sha256`` is over the decimal ids joined by one space, ``decoded_sha256``
    over the UTF-8 of the text that the streaming decoder gives back.
    """
    ship(docs.sparkSession)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]

    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = own.encode(text if isinstance(text, str) else "")
                decimal = " ".join(map(own.decimal.__getitem__, ids.tolist()))
                back = hashlib.sha256()
                for part in own.decode_stream(ids):
                    back.update(part.encode())
                rows.append((doc_id, len(ids), hashlib.sha256(decimal.encode()).hexdigest(), back.hexdigest(), *[ids] * with_ids))
            yield pd.DataFrame(rows, columns=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
