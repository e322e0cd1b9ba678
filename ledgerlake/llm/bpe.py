"""BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a pre-token there is exactly one token that ends its encoding. Candidates are
all tokens that are suffixes of the prefix; an automaton over the vocabulary yields them in one
pass. A candidate holds if it is compatible with the last token of the prefix before it: encoding
the two tokens' bytes together gives back the two. Back-pointers from the end emit the ids. The
work is linear in the text, also for a pre-token of many MB.

Two neighbours are compatible when no merge crosses their border. While the merges inside both
are replayed in order, the pieces at the border run up the right spine of the left token and the
left spine of the right one; a crossing merge happens if it ranks before the next replacement of
either piece (at a tie the pair further left goes first).

The new pre-tokens of about AT_ONCE characters are encoded together, prefix by prefix: numpy takes the
step to the next prefix for all of them at once, with the candidates from a trie. Pre-tokens of more than
64 bytes, and a few alone, go one by one.

Encoding and decoding are maps over Arrow batches; the vocabulary (about 1 MB, a parameter) is
broadcast, and each worker keeps a bounded cache of encoded pre-tokens. Defined cases: null and
empty texts have no ids and decode to an empty text; special tokens of the file that occur in a
text become their own id.
"""

from __future__ import annotations

import itertools
import json
import re
import struct
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import BASE, bounded_memory, kept, pieces, released

CACHE = 50_000  # entries of each of a worker's caches; of encoded pre-tokens twice as many
AT_ONCE = 1 << 18  # characters whose pre-tokens are listed at once
BATCH = 4 << 20  # bytes of texts that a worker is handed at once
# Fixed value: the pre-tokenizer's pattern (white space as Unicode defines it).
PRE_TOKENS = (
    r" ?\p{L}+|'(?:[stmd]|re|ve|ll)| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# The same over U+0000 to U+024F, where the classes are short; most texts stay within.
LATIN_END = "\u024f"
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
LATIN_PRE_TOKENS = f" ?[{_L}]+|'(?:[stmd]|re|ve|ll)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
NEVER = 1 << 60
SHORT = 64  # bytes of the longest pre-token that is encoded together with others, and kept
FEW = 256  # fewer new pre-tokens are encoded one by one
TOGETHER = 1 << 12  # new pre-tokens encoded together at most; bounds the numpy temporaries
FITS = 18  # log2 of the remembered answers whether two tokens are compatible
ID_BITS, ID = 20, (1 << 20) - 1


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: printable Latin-1 for itself, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    def __init__(self, file: str):
        spec = json.loads(file)
        letters = byte_letters()
        vocabulary = spec["model"]["vocab"]
        self.bytes: dict[int, bytes] = {}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}  # pair: rank, id
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in vocabulary.items():
            if token not in self.special:
                self.bytes[i] = bytes(letters[c] for c in token)
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            made = vocabulary[a + b]
            self.merge[vocabulary[a], vocabulary[b]] = rank, made
            if made not in self.parts:
                self.parts[made], self.rank[made] = (vocabulary[a], vocabulary[b]), rank
        self.known: dict[int, bool] = {}
        self.spines: tuple[dict, dict] = {}, {}
        self.fits = np.full(1 << FITS, -1, np.int64)  # pair << 1 | compatible, where its hash says
        self._arrays()
        self.automaton = ahocorasick.Automaton()
        self.whole: dict[str, bytes] = {}
        self.single = [0] * 256
        # A token whose own parts would merge otherwise is never made.
        made = np.array(list(self.parts), np.int64)
        parts = np.array([self.parts[i] for i in made.tolist()], np.int64).reshape(-1, 2)
        ranks = np.array([self.rank[i] for i in made.tolist()], np.int64)
        made = set(made[self._all_borders(parts[:, 0], parts[:, 1], ranks)].tolist())
        for i, b in self.bytes.items():
            if len(b) == 1:
                self.single[b[0]] = i
            elif i in made:
                self.automaton.add_word(b.decode("latin-1"), (i, len(b)))
            else:
                continue
            self.whole[b.decode("latin-1")] = i.to_bytes(4, "little")
        self.automaton.make_automaton()
        self._trie({i: self.bytes[i] for i in made if len(self.bytes[i]) > 1})
        for text, i in self.special.items():
            self.bytes[i] = text.encode()
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pre_tokens = regex.compile(PRE_TOKENS)
        self.latin = re.compile(LATIN_PRE_TOKENS)
        self.beyond = re.compile(f"[^\x00-{LATIN_END}]")
        self.cache: dict[str, bytes] = _Cache(self._encode_one)
        self.table = [self.bytes.get(i, b"") for i in range(max(self.bytes) + 1)]

    def _spine(self, token: int, side: int) -> tuple[list[int], list[int]]:
        """Pieces at the border and when each is replaced, from the first piece to the token."""
        spines = self.spines[side]
        if token not in spines:
            pieces, ends, at = [token], [NEVER], token
            while at in self.parts:
                ends.append(self.rank[at])
                at = self.parts[at][side]
                pieces.append(at)
            spines[token] = pieces[::-1], ends[::-1]
        return spines[token]

    def _borders(self, left: int, right: int, until: int = NEVER) -> bool:
        """No merge that ranks before until crosses the border of the two tokens."""
        a, a_ends = self._spine(left, 1)
        b, b_ends = self._spine(right, 0)
        merge = self.merge
        i = j = 0
        while True:
            crossing = merge.get((a[i], b[j]))
            a_end, b_end = a_ends[i], b_ends[j]
            if crossing is not None and crossing[0] < until and crossing[0] < a_end and crossing[0] <= b_end:
                return False
            if a_end <= b_end:
                if a_end == NEVER:
                    return True
                i += 1
            else:
                j += 1

    def _arrays(self) -> None:
        """The merges sorted by pair, and the spines of all tokens one after the other, as arrays."""
        pairs = sorted((a << ID_BITS | b, rank) for (a, b), (rank, _) in self.merge.items())
        self.pairs, self.pair_rank = np.array([*pairs, (NEVER, NEVER)], np.int64).T.copy()
        n = max(self.bytes) + 1
        rank = np.full(n, NEVER, np.int64)
        parts = np.full((n, 2), -1, np.int64)
        for i, both in self.parts.items():
            rank[i], parts[i] = self.rank[i], both
        self.spine_arrays = []
        for side in (0, 1):
            steps = [(np.arange(n), np.arange(n), np.full(n, NEVER, np.int64))]  # token, piece, when it is replaced
            while len(steps[-1][0]):
                token, piece, _ = steps[-1]
                made = parts[piece, side] >= 0
                steps.append((token[made], parts[piece[made], side], rank[piece[made]]))
            token, piece, until = (np.concatenate(x) for x in zip(*steps[::-1]))
            order = np.argsort(token, kind="stable")
            starts = np.searchsorted(token[order], np.arange(n))
            self.spine_arrays.append((starts, piece[order].astype(np.int32), until[order]))

    def _all_borders(self, left: np.ndarray, right: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """_borders of many pairs."""
        b_at, b_piece, b_until = self.spine_arrays[0]
        a_at, a_piece, a_until = self.spine_arrays[1]
        i, j, row = a_at[left], b_at[right], np.arange(len(left))
        until = np.full(len(left), NEVER) if until is None else until
        out = np.ones(len(left), bool)
        while len(row):
            a_end, b_end = a_until[i], b_until[j]
            pair = a_piece[i].astype(np.int64) << ID_BITS | b_piece[j]
            at = np.searchsorted(self.pairs, pair)
            rank = np.where(self.pairs[at] == pair, self.pair_rank[at], NEVER)
            crossing = (rank < until) & (rank < a_end) & (rank <= b_end)
            out[row[crossing]] = False
            up = a_end <= b_end
            on = ~(crossing | (up & (a_end == NEVER)))
            i, j, row, until = (i + up)[on], (j + ~up)[on], row[on], until[on]
        return out

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Which pairs of tokens are compatible; answers are remembered in a table of fixed size."""
        pair = left << ID_BITS | right
        at = (pair.astype(np.uint64) * BASE >> np.uint64(64 - FITS)).astype(np.int64)
        held = self.fits[at]
        new = np.flatnonzero(held >> 1 != pair)
        if len(new):
            asked, back = np.unique(pair[new], return_inverse=True)
            held[new] = (asked << 1 | self._all_borders(asked >> ID_BITS, asked & ID))[back]
            self.fits[at[new]] = held[new]
        return held & 1 == 1

    def _trie(self, tokens: dict[int, bytes]) -> None:
        """Nodes of the tokens of two and more bytes; the first two bytes lead to theirs by a table."""
        first: dict[bytes, int] = {}
        edges: dict[int, int] = {}
        accepts: list[int] = [-1]
        for i, b in tokens.items():
            node = first.setdefault(b[:2], len(accepts))
            if node == len(accepts):
                accepts.append(-1)
            for c in b[2:]:
                node = edges.setdefault(node << 8 | c, len(accepts))
                if node == len(accepts):
                    accepts.append(-1)
            accepts[node] = i
        self.first = np.zeros(1 << 16, np.int32)
        for two, node in first.items():
            self.first[two[0] << 8 | two[1]] = node
        self.edges, self.targets = np.array([*sorted(edges.items()), (NEVER, 0)], np.int64).T.copy()
        self.accepts = np.array(accepts, np.int32)

    def _candidates(self, raw: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Last byte, size and id of every token of two and more bytes within the words; room: bytes up to a word's end."""
        at = np.flatnonzero(room > 1)
        node = self.first[raw[at].astype(np.int64) << 8 | raw[at + 1]].astype(np.int64)
        at, node = at[node > 0], node[node > 0]
        ends, sizes, ids = [], [], []
        size = 2
        while len(at):
            token = self.accepts[node]
            found = token >= 0
            ends.append(at[found] + (size - 1))
            sizes.append(np.full(len(ends[-1]), size))
            ids.append(token[found].astype(np.int64))
            on = room[at] > size
            at, node = at[on], node[on]
            edge = node << 8 | raw[at + size]
            to = np.searchsorted(self.edges, edge)
            on = self.edges[to] == edge
            at, node = at[on], self.targets[to[on]]
            size += 1
        if not ends:
            return (np.zeros(0, np.int64),) * 3
        return np.concatenate(ends), np.concatenate(sizes), np.concatenate(ids)

    def _encode_many(self, words: list[str]) -> list[bytes]:
        """_encode_one of distinct pre-tokens of at most SHORT bytes."""
        coded = [w.encode() for w in words]
        raw = np.frombuffer(b"".join(coded), np.uint8)
        size = np.fromiter(map(len, coded), np.int64, len(coded))
        stop = np.cumsum(size)
        index = np.arange(len(raw))
        place = index - np.repeat(stop - size, size)
        # Of each prefix its last token: width << ID_BITS | id, so the widest that holds is the largest.
        last = np.array(self.single, np.int64)[raw] | 1 << ID_BITS
        ends, sizes, ids = self._candidates(raw, np.repeat(stop, size) - index)
        order = np.argsort(place[ends].astype(np.uint8), kind="stable")
        ends, sizes, ids = ends[order], sizes[order], ids[order]
        cuts = np.searchsorted(place[ends], np.arange(SHORT + 1))
        for prefix, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if a == b:
                continue
            end, width, token = ends[a:b], sizes[a:b], ids[a:b]
            holds = width > prefix  # nothing is before it
            inside = np.flatnonzero(~holds)
            holds[inside] = self._fit(last[end[inside] - width[inside]] & ID, token[inside])
            np.maximum.at(last, end[holds], width[holds] << ID_BITS | token[holds])
        taken = np.zeros(len(raw), bool)
        at, before = stop - 1, stop - size
        while len(at):
            taken[at] = True
            at = at - (last[at] >> ID_BITS)
            on = at >= before
            at, before = at[on], before[on]
        blob = (last[taken] & ID).astype("<u4").tobytes()
        upto = np.concatenate([[0], np.cumsum(taken)])[stop] * 4
        return [blob[a:b] for a, b in zip([0, *upto.tolist()], upto.tolist())]

    def _learn(self, words: set[str]) -> None:
        """Encode what is new of words, as far as the cache holds it; what is left out is encoded when asked for."""
        held, old = self.cache, self.cache.old
        new = [w for w in words if w not in held and w not in old and (len(w) <= SHORT // 4 or len(w.encode()) <= SHORT)]
        if len(new) < FEW:
            return
        new = new[:CACHE]
        for a in range(0, len(new), TOGETHER):
            part = new[a : a + TOGETHER]
            for word, ids in zip(part, self._encode_many(part)):
                held.keep(word, ids)

    def _encode_one(self, word: str) -> bytes:
        raw = word.encode()
        text = raw.decode("latin-1")
        if (one := self.whole.get(text)) is not None:
            return one
        # Every prefix has a last token, so where no longer candidate holds it is the single byte.
        last = [self.single[b] for b in raw]
        width = [1] * len(raw)
        known = self.known
        for end, (token, size) in self.automaton.iter(text):
            if width[end] > 1:
                continue
            start = end - size
            if start >= 0:
                pair = last[start] << 20 | token
                try:
                    ok = known[pair]
                except KeyError:
                    if len(known) >= CACHE:
                        known.clear()
                    ok = known[pair] = self._borders(last[start], token)
                if not ok:
                    continue
            last[end], width[end] = token, size
        ids, at = [], len(raw) - 1
        while at >= 0:
            ids.append(last[at])
            at -= width[at]
        return struct.pack(f"<{len(ids)}I", *reversed(ids))

    def _pre(self, text: str):
        pattern = self.pre_tokens if self.beyond.search(text) else self.latin
        if len(text) <= AT_ONCE:
            yield pattern.findall(text)
        else:
            found = (m[0] for m in pattern.finditer(text))
            while part := list(itertools.islice(found, 100_000)):
                yield part

    def _cut(self, text: str):
        """The text's special tokens as their ids, and between them lists of pre-tokens."""
        for part in self.split.split(text) if self.split else [text]:
            if part in self.special:
                yield self.special[part].to_bytes(4, "little")
            elif part:
                yield from self._pre(part)

    def _ids(self, part: bytes | list[str]) -> bytes:
        return part if isinstance(part, bytes) else b"".join(map(self.cache.__getitem__, part))

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        out = []
        for part in self._cut(text):
            if len(part) >= FEW and not isinstance(part, bytes):
                self._learn(set(part))
            out.append(self._ids(part))
        return b"".join(out)

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """encode of each text; new pre-tokens of about AT_ONCE characters are encoded together."""
        held, chars = [], 0
        for text in itertools.chain(texts, [None]):
            if text is None or chars + len(text) > AT_ONCE:
                self._learn(set().union(*(p for parts in held for p in parts if not isinstance(p, bytes))))
                yield from (b"".join(map(self._ids, parts)) for parts in held)
                held, chars = [], 0
            if text is not None and len(text) > AT_ONCE:
                yield self.encode(text)
            elif text is not None:
                held.append(list(self._cut(text)))
                chars += len(text)

    def decode(self, ids: bytes) -> str:
        table = self.table
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


class _Cache(dict):
    """Encoded pre-tokens; once CACHE are held they become the old ones, of which those asked for again stay."""

    def __init__(self, make: Callable[[str], bytes]):
        self.make = make
        self.old: dict[str, bytes] = {}

    def keep(self, word: str, out: bytes) -> None:
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        self[word] = out

    def __missing__(self, word: str) -> bytes:
        out = self.old.get(word)
        if out is None:
            out = self.make(word)
        if len(word) <= SHORT:
            self.keep(word, out)
        return out


def _codec(file: Broadcast) -> Codec:
    """One codec per worker and vocabulary."""
    return kept(f"codec-{hash(file.value)}", lambda: Codec(file.value))


def vocabulary(spark, path: str | None = None) -> Broadcast:
    """The tokenizer file's text, read on the driver and broadcast."""
    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(text: Column, file: Broadcast) -> Column:
    """Binary column: ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("binary")
    def ids(column: pa.Array) -> pa.Array:
        codec = _codec(file)
        return released(pa.array(list(codec.encode_all(t.as_py() or "" for t in column)), pa.binary()))

    return ids(F.coalesce(text, F.lit("")))


def decode(ids: Column, file: Broadcast) -> Column:
    @F.arrow_udf("string")
    def text(column: pa.Array) -> pa.Array:
        codec = _codec(file)
        return pa.array([codec.decode(b.as_py() or b"") for b in column], pa.string())

    return text(ids)


def encode_decode(text: Column, file: Broadcast) -> Column:
    """Struct column of encode and decode; as two columns, of which one needs the other, texts would be encoded twice."""

    @F.arrow_udf("token_ids binary, decoded string")
    def both(column: pa.Array) -> pa.Array:
        codec = _codec(file)
        made = [_both(codec, piece) for piece in pieces(column)]
        return pa.concat_arrays(made) if made else _both(codec, column)

    return both(F.coalesce(text, F.lit("")))


def _both(codec: Codec, column: pa.Array) -> pa.StructArray:
    """Ids and decoded texts of some texts; what encoding them took is given back."""
    ids = list(codec.encode_all(t.as_py() or "" for t in column))
    texts = pa.array(map(codec.decode, ids), pa.string())
    return released(pa.StructArray.from_arrays([pa.array(ids, pa.binary()), texts], ["token_ids", "decoded"]))


def encoded(df: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """df with the columns token_ids (binary) and decoded (string)."""
    bounded_memory(df.sparkSession, BATCH)
    file = vocabulary(df.sparkSession, path)
    made = df.withColumn("token_ids", encode_decode(F.col(text_col), file))
    rest = [F.col(f"`{c}`") for c in df.columns if c not in ("token_ids", "decoded")]
    return made.select(*rest, "token_ids.token_ids", "token_ids.decoded")


def digests(df: DataFrame) -> DataFrame:
    return encoded(df.select("doc_id", "text")).select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
