"""Byte-level BPE encoding and decoding by a lazily determinised transducer.

A sequence of tokens is the BPE encoding of its bytes exactly if every two
neighbours are (no merge fires across their border). Each prefix of a text has
one encoding, and a longer one extends that of some prefix by one token. So a
state of the subset construction holds the open paths into the vocabulary's
trie, each with the token before it; reading a byte moves the paths on and
closes the one token that ends the encoding of what has been read. States and
edges are made when first needed. Tokens are emitted as far as all open paths
agree on them; no path is longer than the longest token, which bounds the
lookahead. The many short pieces of a batch go through it side by side, a byte
of each at a time.

Decoding joins the tokens' bytes and runs an incremental UTF-8 decoder, whose
state is the unfinished sequence at the end of what it has seen.
"""

from __future__ import annotations

from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.llm.common import column_of, number_columns, vocabulary_path
from boxoffice.llm.token_counts import read_ranks

VOCABULARY = "byte_bpe_50k.tiktoken"
REMEMBERED_EDGES = 600_000  # by a worker; beyond them it starts afresh
REMEMBERED_WORDS = REMEMBERED_PIECES = 0  # none are remembered from batch to batch any more; tests still set these names
SIDE_BY_SIDE = 64  # bytes of a piece that is encoded together with others, at most
BATCH_BYTES = 1 << 21  # of the texts that are encoded together, but for the last one
EMIT_STEP = 4096  # bytes after which a long piece's settled tokens are emitted
DECODE_STEP = 4096  # tokens that the streaming decoder takes at a time
FOREVER, LAST = 1 << 60, (1 << 17) - 1
MIX = np.uint64(0x9E3779B97F4A7C15)


class Borders(dict):
    """Whether two tokens can be neighbours in an encoding, by (left + 1) << 17 | right."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        super().__init__()
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.edges: dict[tuple[int, int], list[tuple[bytes, int, int]]] = {}

    def halves(self, token: bytes) -> tuple[bytes, bytes]:
        """The two tokens whose merge makes ``token``."""
        pieces = [token[i:i + 1] for i in range(len(token))]
        while len(pieces) > 2:
            best = min(range(len(pieces) - 1),
                       key=lambda i: self.ranks.get(pieces[i] + pieces[i + 1], FOREVER))
            pieces[best:best + 2] = [pieces[best] + pieces[best + 1]]
        return pieces[0], pieces[1]

    def edge(self, rank: int, side: int) -> list[tuple[bytes, int, int]]:
        """What stands at a token's right (1) or left (0) end over time: (symbol, from, until)."""
        if (rank, side) not in self.edges:
            token, until, found = self.bytes_of[rank], FOREVER, []
            while len(token) > 1:
                found.append((token, self.ranks[token], until))
                until = self.ranks[token]
                token = self.halves(token)[side]
            self.edges[rank, side] = [*found, (token, -1, until)]
        return self.edges[rank, side]

    def __missing__(self, key: int) -> bool:
        """No merge across the border comes before the merges inside the two tokens.

        Equal merges go from left to right: one inside the left token precedes,
        one inside the right token follows a merge across of the same rank.
        """
        ranks = self.ranks
        allowed = True
        for a, a_from, a_until in self.edge((key >> 17) - 1, 1):
            for b, b_from, b_until in self.edge(key & LAST, 0):
                if max(a_from, b_from) < min(a_until, b_until) and (rank := ranks.get(a + b)) is not None \
                        and max(rank, b_from) < a_until and max(rank, a_from) <= b_until:
                    allowed = False
        self[key] = allowed
        return allowed


class Edges(dict):
    """The transducer's edges, each made by ``step`` when first needed."""

    def __init__(self, step) -> None:
        super().__init__()
        self.step = step

    def __missing__(self, at: int) -> int:
        to = self[at] = self.step(at)
        return to


class EdgeTable:
    """The same for many edges at once: open addressing, -1 where nothing is."""

    def __init__(self, slots: int = 1 << 16) -> None:
        self.size, self.mask = 0, slots - 1
        self.at, self.to = np.full(slots, -1, np.int64), np.empty(slots, np.int64)

    def slots(self, at: np.ndarray) -> np.ndarray:
        return ((at.astype(np.uint64) * MIX) >> np.uint64(40)).astype(np.int64) & self.mask

    def put(self, at: np.ndarray, to: np.ndarray) -> None:
        """New edges, each once."""
        if 2 * (self.size + len(at)) > len(self.at):
            old = self.at >= 0
            at, to = np.concatenate([self.at[old], at]), np.concatenate([self.to[old], to])
            self.__init__(1 << (4 * len(at)).bit_length())
        self.size += len(at)
        slot = self.slots(at)
        while len(at):
            free = self.at[slot] < 0
            self.at[slot[free]] = at[free]  # of several that want a slot one gets it
            got = self.at[slot] == at
            self.to[slot[got]] = to[got]
            at, to, slot = at[~got], to[~got], slot[~got] + 1 & self.mask

    def get(self, at: np.ndarray) -> np.ndarray:
        """Where edges lead; -1 for those not there."""
        slot = self.slots(at)
        there = self.at[slot]
        to = np.where(there == at, self.to[slot], -1)
        on = np.flatnonzero((there != at) & (there >= 0))
        while len(on):
            slot[on] = slot[on] + 1 & self.mask
            there = self.at[slot[on]]
            hit = there == at[on]
            to[on[hit]] = self.to[slot[on[hit]]]
            on = on[~hit & (there >= 0)]
        return to


class Transducer:
    """Bytes of a piece of text in, BPE tokens out.

    A state is a tuple of paths, the longest first: trie node << 17 | token
    before it + 1 (0: none). Its last path stands at the root, behind the token
    closed. Edges lead from state << 8 | byte to the next state << 8.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        if len(ranks) >= LAST or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary must hold every single byte, and below 2^17 tokens")
        self.ranks = ranks
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.length[rank] = len(token)
        self.lengths = self.length.tolist()
        self.trie: dict[int, int] = {}
        self.token_at, self.depth = [-1], [0]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                if key not in self.trie:
                    self.trie[key] = len(self.token_at)
                    self.token_at.append(-1)
                    self.depth.append(self.depth[node] + 1)
                node = self.trie[key]
            self.token_at[node] = rank
        self.borders = Borders(ranks)
        self.forget()

    def forget(self) -> None:
        self.states: list[tuple[int, ...]] = [(0,)]
        self.closed = array("i", [-1])  # by each state
        self.numbers = {(0,): 0}
        self.edges, self.table = Edges(self.step), EdgeTable()
        self.borders.clear()

    def step(self, at: int) -> int:
        """Where the edge of state << 8 | byte leads."""
        trie, token_at, borders, byte = self.trie, self.token_at, self.borders, at & 255
        paths, closed = [], -1
        for path in self.states[at >> 8]:
            child = trie.get(path >> 17 << 8 | byte)
            if child is None:
                continue
            before = path & LAST
            paths.append(child << 17 | before)
            token = token_at[child]
            if token >= 0 and closed < 0 and (not before or borders[before << 17 | token]):
                closed = token
        key = (*paths, closed + 1)
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states) << 8
            self.states.append(key)
            self.closed.append(closed)
        return number

    def back(self, passed: list[int], end: int) -> list[int]:
        """The tokens of the encoding of the first ``end`` bytes, last first."""
        out, closed, length = [], self.closed, self.lengths
        while end > 0:
            token = closed[passed[end - 1] >> 8]
            out.append(token)
            end -= length[token]
        return out

    def settled(self, passed: list[int]) -> int:
        """Where the encodings that the open paths extend agree up to."""
        chains = []
        for path in self.states[passed[-1] >> 8]:
            end = len(passed) - self.depth[path >> 17]
            chain = {end}
            for token in self.back(passed, end):
                end -= self.lengths[token]
                chain.add(end)
            chains.append(chain)
        return max(set.intersection(*chains))

    def encode(self, data: bytes) -> list[int]:
        if len(self.edges) + self.table.size > REMEMBERED_EDGES:
            self.forget()
        edges, state, out = self.edges, 0, []
        passed: list[int] = []  # the states behind each byte not yet emitted
        for at in range(0, len(data), EMIT_STEP):
            for byte in data[at:at + EMIT_STEP]:
                state = edges[state | byte]
                passed.append(state)
            if at + EMIT_STEP < len(data):
                done = self.settled(passed)
                out += reversed(self.back(passed, done))
                del passed[:done]
        out += reversed(self.back(passed, len(passed)))
        return out

    def follow(self, at: np.ndarray) -> np.ndarray:
        """Where the edges of state << 8 | byte lead."""
        to = self.table.get(at)
        if (to < 0).any():
            new = np.unique(at[to < 0])
            self.table.put(new, np.array([self.step(x) for x in new.tolist()], np.int64))
            to = self.table.get(at)
        return to

    def encode_side_by_side(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of many short pieces of ``data``: all tokens, and where each piece's begin and how many they are."""
        if len(self.edges) + self.table.size > REMEMBERED_EDGES:
            self.forget()
        longest = np.argsort(-sizes, kind="stable")
        lanes, downward = starts[longest], -sizes[longest]
        state, passed = np.zeros(len(sizes), np.int64), np.zeros(len(data), np.int64)
        for j in range(int(sizes.max(initial=0))):
            m = int(np.searchsorted(downward, -j, "left"))  # pieces longer than j
            at = lanes[:m] + j
            state = passed[at] = self.follow(state[:m] | data[at])
        token = np.frombuffer(self.closed, np.int32)[passed >> 8]
        last, end, start = np.zeros(len(data) + 1, bool), starts + sizes, starts
        while len(end):  # back from token to token
            left = end > start
            end, start = end[left], start[left]
            last[end] = True
            end = end - self.length[token[end - 1]]
        before = np.cumsum(last)
        return token[last[1:]], before[starts], before[starts + sizes] - before[starts]


def gathered(flat: np.ndarray, first: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Strings of ``flat`` (where they begin, their sizes), one after the other in the order of ``which``."""
    size = size[which]
    at = np.repeat(first[which] - (np.cumsum(size) - size), size)
    return flat[at + np.arange(len(at))]


class Encoder:
    """Texts to token ids (int32).

    No piece holds a space behind anything else but white space, so a text may
    be cut before a space that has no other white space beside it. What lies
    between cuts is encoded once for all the texts of a batch.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self.transducer = Transducer(ranks)
        self.pieces = regex.compile(pattern).findall
        self.latest: tuple[pa.Array, pa.Array] | None = None  # texts and their ids

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, and where each piece's begin and how many they are."""
        strings = pa.array(pieces, pa.string())
        sizes = pc.binary_length(strings).to_numpy().astype(np.int64)
        data = np.frombuffer(strings.buffers()[2] or b"", np.uint8)[:sizes.sum()]
        short = sizes <= SIDE_BY_SIDE
        ids, first, size = self.transducer.encode_side_by_side(data, np.cumsum(sizes) - sizes, np.where(short, sizes, 0))
        parts, total = [ids], len(ids)
        for i in np.flatnonzero(~short).tolist():
            parts.append(np.array(self.transducer.encode(pieces[i].encode()), np.int32))
            first[i], size[i] = total, len(parts[-1])
            total += len(parts[-1])
        return np.concatenate(parts), first, size

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (without nulls), and how many each has."""
        cuts = pc.split_pattern(texts, " ")
        length = pc.list_value_length(cuts).to_numpy()
        begin = np.cumsum(length) - length  # each text's first part, which has no space before it
        coded = cuts.flatten().dictionary_encode()
        words, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        fits = np.array([w.isalpha() for w in words], bool)  # letters only are one piece
        alone, others = np.flatnonzero(fits), np.flatnonzero(~fits).tolist()
        mixed = [i for i in others if words[i] and not words[i][0].isspace() and not words[i][-1].isspace()]
        fits[mixed] = True
        forbidden = ~fits[which]
        firsts = [words[k] for k in which[begin].tolist()]
        forbidden[begin] = [w[-1:].isspace() for w in firsts]
        whole = np.logical_or.reduceat(forbidden, begin)  # texts that are not cut
        # the pieces of words, each with a space before it, then of the first parts
        among = self.pieces(" " + " ".join([words[i] for i in mixed])) if mixed else []
        opening = [i for i, p in enumerate(among) if p[0] == " "]
        spans = [self.pieces(texts[i].as_py() if w else firsts[i]) for i, w in enumerate(whole.tolist())]
        pieces = [" " + words[i] for i in alone.tolist()] + among + [p for span in spans for p in span]
        # where the pieces of each part begin and how many they are; the last part has none
        first, size = np.zeros((2, len(words) + len(spans) + 1), np.int64)
        first[alone], size[alone] = np.arange(len(alone)), 1
        first[mixed], size[mixed] = len(alone) + np.array(opening, np.int64), np.diff([*opening, len(among)])
        size[len(words):-1] = [len(span) for span in spans]
        first[len(words):-1] = len(pieces) - size[len(words):].sum() + np.cumsum(size[len(words):-1]) - size[len(words):-1]
        parts = np.where(np.repeat(whole, length), len(first) - 1, which)
        parts[begin] = len(words) + np.arange(len(begin))
        ids, at, n = self.encode_pieces(pieces)
        in_order = gathered(ids, at, n, gathered(np.arange(len(pieces)), first, size, parts))
        before = np.append(0, np.cumsum(n))
        return in_order, np.add.reduceat(before[first + size][parts] - before[first][parts], begin)

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has; a null text counts as empty."""
        texts = pc.fill_null(texts, "")
        batch = np.cumsum(pc.binary_length(texts).to_numpy()) // BATCH_BYTES
        edges = [0, *(np.flatnonzero(np.diff(batch)) + 1).tolist(), len(texts)]
        done = [self.encode_batch(texts[a:b]) for a, b in zip(edges, edges[1:]) if a < b]
        return tuple(np.concatenate(x) for x in zip(*done)) if done else (np.empty(0, np.int32), np.empty(0, np.int64))

    def encode_array(self, texts: pa.Array) -> pa.Array:
        """The ids of each text, as a list.

        Where Spark puts this into another Python function, it runs it for
        that one and for its own column, on the same batch.
        """
        if self.latest is None or not self.latest[0].equals(texts):
            ids, n = self.encode_texts(texts)
            self.latest = texts, pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(ids))
        return self.latest[1]

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_texts(pa.array([text], pa.string()))[0]


class Utf8Stream:
    """Incremental UTF-8 decoding: bytes in any portions to text; malformed bytes become U+FFFD."""

    def __init__(self) -> None:
        self.open = b""  # an unfinished sequence

    @staticmethod
    def unfinished(data: bytes) -> int:
        """Length of the sequence at the end of ``data`` that further bytes could complete."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte < 0x80:
                return 0
            if byte >= 0xC0:  # a lead byte, followed by back - 1 continuation bytes
                need = 2 if 0xC2 <= byte < 0xE0 else 3 if 0xE0 <= byte < 0xF0 else 4 if 0xF0 <= byte < 0xF5 else 1
                low = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
                high = {0xED: 0x9F, 0xF4: 0x8F}.get(byte, 0xBF)
                fits = back == 1 or low <= data[1 - back] <= high
                return back if back < need and fits else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.open + data
        rest = self.unfinished(data)
        done = len(data) - rest
        self.open = data[done:]
        return data[:done].decode("utf-8", "replace")

    def close(self) -> str:
        data, self.open = self.open, b""
        return data.decode("utf-8", "replace")


class Decoder:
    """Token ids to text, a portion at a time."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.size = np.array([len(t) for t in tokens], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def bytes_of(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        at = np.repeat(self.start[ids] - (np.cumsum(size) - size), size)
        return self.flat[at + np.arange(len(at))].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        stream = Utf8Stream()
        out = [stream.feed(self.bytes_of(ids[at:at + DECODE_STEP])) for at in range(0, len(ids), DECODE_STEP)]
        return "".join(out) + stream.close()


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(path), pattern)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(read_ranks(path))


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def token_ids(text: Column, vocabulary: str = VOCABULARY, pattern: str | None = None) -> Column:
    """The ids of a text as array<int>, without special tokens; null and empty texts give an empty array."""
    path, pattern = vocabulary_path(vocabulary), pattern or default_pattern()

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encoded(texts: pa.Array) -> pa.Array:
        return encoder(path, pattern).encode_array(texts)

    return encoded(text)


def decoded_text(ids: Column, vocabulary: str = VOCABULARY) -> Column:
    """The text of an array of ids; a null or empty array gives an empty text."""
    path = vocabulary_path(vocabulary)

    @F.arrow_udf(T.StringType())
    def decoded(arrays: pa.Array) -> pa.Array:
        decode = decoder(path).decode
        if arrays.null_count:
            arrays = pa.array([a or [] for a in arrays.to_pylist()], pa.list_(pa.int32()))
        flat, ends = arrays.values.to_numpy(zero_copy_only=False), arrays.offsets.to_numpy()
        return pa.array([decode(flat[a:b]) for a, b in zip(ends, ends[1:])], pa.string())

    return decoded(ids)


def encode_documents(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with a last column ``ids``: the token ids of ``text``.

    Each row by itself: repeated rows repeat, an empty table stays empty. An
    extra column called ``ids`` is kept beside it under ``ids_in``.
    """
    df, names = number_columns(docs)
    out = df.withColumn("_xids", token_ids(column_of(names, "text"), vocabulary))
    return out.toDF(*[f"{n}_in" if n.lower() == "ids" else n for n in names], "ids")


def encoding_report(encoded: DataFrame, *more: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, the digests of the ids and of the text decoded from them, and the columns ``more``."""
    text = decoded_text(F.col("ids"), vocabulary)
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(text.cast("binary"), 256).alias("decoded_sha256"), *more)
