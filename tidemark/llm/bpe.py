"""Byte-level BPE as a lazily determinised transducer, and streaming decoding.

The merges of a rank file are compiled into a transducer over bytes.  A state
is what is still undecided: the bytes since the last token that is certain,
and that token.  Reading a byte gives the next state and the tokens that no
later byte can change.  States and steps are made when first needed.

Two facts make a step cheap.  A sequence of tokens is the encoding of its bytes
exactly if each neighbouring pair is the encoding of its own bytes.  So the last
token of a prefix is the one suffix that is a token and pairs with the last
token of what stands before it.  And a place can only start a later token while
the bytes after it begin some token; tokens that all such places have in common
are certain, which bounds the lookahead by the longest token.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import islice
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, read_table, slices, type_of

#: Pieces handled at once, so that a very long text is never held as one list of pieces.
PIECES = 50_000
#: Bounds of a worker's memory: pieces remembered, and states of the transducer.
CACHED_PIECES, CACHED_STATES = 400_000, 250_000
#: The rank of a merge that does not exist.
NEVER = 1 << 62
#: Pieces longer than this are encoded without being remembered.
CACHED_LENGTH = 64


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


class MergeTransducer:
    """Encodes one piece (a match of the split pattern) byte by byte.

    A state is ``(before, pending, places)``: the last certain token, the bytes
    after it, and the places in those bytes at which a later token can start,
    each with the tokens that lead to it.  The last place is the end, so its
    tokens are what the state emits if the piece ends here.
    """

    def __init__(self, ranks: dict[bytes, int], max_states: int = CACHED_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.begins = {token[:n] for token in ranks for n in range(1, len(token))}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.reached: dict[bytes, int | None] = {}
        self.sides: dict[int, tuple] = {}
        self.forget()

    def forget(self) -> None:
        """Back to the start state alone."""
        self.steps: list[dict[int, tuple[int, tuple[int, ...]]]] = []
        self.states: list[tuple] = []
        self.names: dict[tuple[int | None, bytes], int] = {}
        self.start = self._state(None, b"", ((0, ()),))

    def _state(self, before: int | None, pending: bytes, places: tuple) -> int:
        name = (before, pending)
        if (state := self.names.get(name)) is None:
            state = self.names[name] = len(self.states)
            self.states.append((before, pending, places))
            self.steps.append({})
        return state

    def _merges(self, token: bytes) -> tuple[list[tuple[int, bytes, bytes]], bool]:
        """The merges of a token's own bytes, by rank and leftmost first: rank, first and last part after it.

        Also whether they end in the token itself.
        """
        parts = [token[i:i + 1] for i in range(len(token))]
        done = [(-1, parts[0], parts[-1])]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            if rank == NEVER:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            done.append((rank, parts[0], parts[-1]))
        return done, len(parts) == 1

    def _token(self, piece: bytes) -> int | None:
        """The token of these bytes if the merges can reach it."""
        if piece not in self.reached:
            rank = self.ranks.get(piece)
            if rank is None:
                return None
            done, whole = self._merges(piece)
            self.reached[piece] = rank if whole else None
            # What the neighbour of the token meets: (rank of the next own merge, part at that side).
            ranks = [d[0] for d in done[1:]] + [NEVER]
            self.sides[rank] = ([(r, d[1]) for r, d in zip(ranks, done)], [(r, d[2]) for r, d in zip(ranks, done)])
        return self.reached[piece]

    def _pair(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens' bytes end in just these two.

        Both sides go through their own merges, the lower rank first; the pair
        fails if a merge over the border ever comes first.
        """
        if (known := self.pairs.get((left, right))) is not None:
            return known
        own, other = self.sides[left][1], self.sides[right][0]
        i = j = 0
        while True:
            (x, a), (y, b) = own[i], other[j]
            across = self.ranks.get(a + b, NEVER)
            if across < x and across <= y:
                valid = False
                break
            if x == y == NEVER:
                valid = True
                break
            if x <= y:
                i += 1
            else:
                j += 1
        if len(self.pairs) > 5 * self.max_states:
            self.pairs.clear()
        self.pairs[left, right] = valid
        return valid

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        before, pending, places = self.states[state]
        pending += bytes((byte,))
        still, end = [], None
        for start, tokens in places:
            piece = pending[start:]
            if end is None and (token := self._token(piece)) is not None:
                left = tokens[-1] if tokens else before
                if left is None or self._pair(left, token):
                    end = (len(pending), (*tokens, token))
            if piece in self.begins:
                still.append((start, tokens))
        still.append(end)
        certain, common = 0, still[0][1]
        if common:
            for certain in range(len(common), 0, -1):
                if all([tokens[:certain] == common[:certain] for _, tokens in still]):
                    break
            else:
                certain = 0
        if not certain:
            return self._state(before if still[0][0] == 0 else None, pending, tuple(still)), ()
        emitted = end[1][:certain]
        cut = sum([len(self.bytes_of[token]) for token in emitted])
        moved = tuple([(start - cut, tokens[certain:]) for start, tokens in still])
        # The token before matters only while a token can still start right after it.
        before = emitted[-1] if moved[0][0] == 0 else None
        return self._state(before, pending[cut:], moved), emitted

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one piece.  A piece that is itself a token is that token, reached by merges or not."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        out: list[int] = []
        state, steps = self.start, self.steps
        for byte in piece:
            found = steps[state].get(byte)
            if found is None:
                found = steps[state][byte] = self._step(state, byte)
                if len(self.states) > self.max_states:  # go on from this state with empty tables
                    kept = self.states[found[0]]
                    self.forget()
                    steps, found = self.steps, (self._state(*kept), found[1])
            state, emitted = found
            if emitted:
                out.extend(emitted)
        out.extend(self.states[state][2][-1][1])
        return out


class Pieces(dict):
    """Piece -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, transducer: MergeTransducer):
        super().__init__()
        self.transducer = transducer

    def __missing__(self, piece: str) -> bytes:
        found = self.transducer.encode(piece.encode())
        ids = pack(f"<{len(found)}I", *found)
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    def __init__(self, path: str, pattern: str):
        self.pieces = Pieces(MergeTransducer(load_ranks(path)))
        # The split pattern means white space by its Unicode property.
        self.split = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))

    def encode(self, text: str) -> bytes:
        find = self.pieces.__getitem__
        if len(text) <= 8 * PIECES:
            return b"".join(map(find, self.split.findall(text)))
        matches = (m[0] for m in self.split.finditer(text))
        out = []
        while part := b"".join(map(find, islice(matches, PIECES))):
            out.append(part)
        return b"".join(out)


class Utf8Stream:
    """Bytes in any portions to text: an incremental UTF-8 state machine.

    Between portions it holds the at most three bytes of a character begun but
    not finished.  Malformed bytes become U+FFFD, as in any decoder with
    replacement; `finish` turns an unfinished character into it.
    """

    def __init__(self):
        self.held = b""

    @staticmethod
    def _open(data: bytes) -> int:
        """How many bytes at the end begin a character without finishing it."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead & 0xC0 == 0x80:
                continue
            need = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 1
            if back >= need:
                return 0
            if back > 1:  # the second byte of some leads has a narrower range
                low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(lead, (0x80, 0xBF))
                if not low <= data[1 - back] <= high:
                    return 0
            return back
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data) - self._open(data)
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


def decode_ids(bytes_of: list[bytes], ids: bytes) -> Iterator[bytes]:
    """The bytes of the tokens, in portions; an unknown id is an error."""
    numbers = np.frombuffer(ids, dtype="<u4")
    for at in range(0, len(numbers), PIECES):
        yield b"".join(map(bytes_of.__getitem__, numbers[at:at + PIECES].tolist()))


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text: id, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers).

    `path` names a rank file that every executor can open.  A null text is the
    empty text, which has no tokens.  Each row is encoded by itself, so ids may
    be null or repeat; no rows give no rows; other columns are not read.
    """

    def run(batches):
        encoder = Encoder(path, pattern)
        for batch in slices(batches):
            ids = [encoder.encode(t) if t else b"" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=["id", "n_tokens", "ids"],
            )

    rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).cast("string").alias("text"))
    kind = type_of(rows, "id")
    return rows.mapInArrow(run, f"id {kind}, n_tokens bigint, ids binary").withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """The text of ``ids``: `encoded` with ``text`` (U+FFFD for malformed bytes) and ``n_bytes``.

    Null ids are an empty list and give the empty text.
    """

    def run(batches):
        ranks = load_ranks(path)
        bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            bytes_of[rank] = token
        for batch in slices(batches):
            texts, sizes = [], []
            for ids in batch.column("ids").to_pylist():
                stream, size, out = Utf8Stream(), 0, []
                for part in decode_ids(bytes_of, ids or b""):
                    size += len(part)
                    out.append(stream.feed(part))
                texts.append("".join([*out, stream.finish()]))
                sizes.append(size)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string()), pa.array(sizes, pa.int64())],
                names=[*batch.schema.names, "text", "n_bytes"],
            )

    rows = encoded.select(quoted(id_col).alias("id"), "n_tokens", "ids")
    kind = type_of(rows, "id")
    return rows.mapInArrow(
        run, f"id {kind}, n_tokens bigint, ids binary, text string, n_bytes bigint"
    ).withColumnRenamed("id", id_col)


def digests(decoded: DataFrame) -> DataFrame:
    """What the contract asks for, from real ids and texts."""
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = encode_documents(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return digests(decode_documents(encoded, path))
