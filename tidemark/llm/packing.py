"""Order-preserving packing of token streams into fixed windows.

Documents are tokenised and laid end to end in their order. Dynamic
programming chooses where the stream is cut into windows of at most
``WINDOW`` tokens: a cut after a document costs nothing, after a sentence a
little, elsewhere more; a window costs its padding. With
``f(j) = min over i of f(i) + WINDOW - (j - i) + penalty(j)`` the minimum of
``f(i) + i`` over the last ``WINDOW`` positions is kept in a monotone queue.
A window whose length is a power of two needs no padding; those
predecessors are looked up one by one.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table, text_or_empty, worker_state

WINDOW = 4096
END_ID = 2  # the id put after each document
SENTENCE_CUT = 8.0  # penalty, in padded tokens, of a cut after a sentence
INNER_CUT = 64.0  # of any other cut inside a document
WINDOW_COST = 16.0  # of one more window
GRID = 256  # cuts inside a sentence are tried at multiples of this
CHUNK = 1 << 18  # tokens that one run of the dynamic programming covers
PART_BYTES = 16 << 20  # text bytes of one packed run of documents
CACHED, RECENT = 150_000, 100_000  # words remembered, and words met once: some 35 MB a worker
JOINED = 500  # pieces encoded as one text
BATCH = 2 << 20  # text bytes (of a long text: characters) encoded together

# The normaliser composes, lowers and joins white space. In texts without these
# characters (Latin, Cyrillic and common signs remain) lowering is all it does.
OTHER = re.compile("[^\\x00-\u012f\u0131-\u024f\u0400-\u045f\u2010-\u2027]")
SPACE = re.compile(r"[\x09-\x0d\x20]")
# Kinds of bytes, and the pairs between which the pre-tokenizer always cuts.
# "'" may start a piece with the letters after it; REST may combine.
KINDS = WHITE, LETTER, DIGIT, SIGN, QUOTE, REST = range(6)
KIND = np.full(256, REST, np.uint8)
KIND[33:127] = SIGN
KIND[list(b" \t\n\v\f\r")] = WHITE
KIND[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = LETTER
KIND[list(b"0123456789")] = DIGIT
KIND[ord("'")] = QUOTE
PAIR = np.zeros(1 << 16, bool)  # letters of two bytes that stay one when lowered
PAIR[[int.from_bytes(c.encode(), "big") for c in map(chr, [*range(0xC0, 0x180), *range(0x400, 0x460)])
      if c.isalpha() and len(c.lower()) == 1]] = True
CUT = np.zeros((len(KINDS), len(KINDS)), bool)
CUT[WHITE, LETTER:] = True
CUT[LETTER, [DIGIT, SIGN, QUOTE]] = True
CUT[DIGIT, [LETTER, DIGIT, SIGN, QUOTE]] = True
CUT[SIGN, [LETTER, DIGIT]] = True
CUT[QUOTE, DIGIT] = True
CUT = CUT.ravel()


class Encoder:
    """Token ids of whole texts, equal to the tokenizer's own.

    This tokenizer never merges across white space, nor across the pieces its
    pre-tokenizer cuts, so texts are cut into words wherever that is certain
    from two bytes, ids of words are remembered, and only unseen pieces go
    through the tokenizer's model. A piece is a word cut into itself. ``known``
    keeps words met again (up to ``CACHED``), ``recent`` those met once.
    """

    def __init__(self, path: str):
        from tokenizers import Regex, Tokenizer, pre_tokenizers
        self.whole = Tokenizer.from_file(path)
        # pieces hold no white space: many are encoded as one text, cut at word ends
        self.pieces = Tokenizer(self.whole.model)
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # fixed: the pre-tokenizer's own pattern
        self.cut = pre_tokenizers.Split(Regex(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"),
                                        "removed", invert=True)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.known: dict[bytes, bytes] = {}
        self.recent: dict[bytes, bytes] = {}
        stops = set(".!?")
        size = self.whole.get_vocab_size()
        self.sentence_end = np.zeros(size, bool)
        self.word_end = np.zeros(size, bool)
        for token, i in self.whole.get_vocab().items():
            body = token.removesuffix("</w>")
            self.word_end[i] = body != token
            if body and body != token and set(body) & stops and not any(c.isalnum() for c in body):
                self.sentence_end[i] = True

    def _ids_of(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of pieces. The last id of each, and no other, ends a word."""
        out: dict[bytes, bytes] = {}
        runs = [pieces[lo:lo + JOINED] for lo in range(0, len(pieces), JOINED)]
        for run, enc in zip(runs, self.pieces.encode_batch_fast([b" ".join(r).decode() for r in runs],
                                                                add_special_tokens=False)):
            ids = np.array(enc.ids, np.uint32)
            data, ends = ids.tobytes(), ((np.flatnonzero(self.word_end[ids]) + 1) * 4).tolist()
            if len(ends) != len(run):
                raise ValueError("a piece was split")
            lo = 0
            for p, hi in zip(run, ends):
                out[p] = data[lo:hi]
                lo = hi
        return out

    def _pieces(self, word: bytes) -> list[bytes]:
        """Pieces of a word. Lowered letters alone need no tokenizer."""
        s = word.decode()
        if s.isalpha() and s.islower() and not OTHER.search(s):
            return [word]
        return [p.encode() for p, _ in self.cut.pre_tokenize_str(self.whole.normalizer.normalize_str(s))]

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct words, none of them in ``known``."""
        known, recent = self.known, self.recent
        again = {w: recent[w] for w in words if w in recent}
        new = [w for w in words if w not in recent]
        cut = {w: self._pieces(w) for w in new if not (w.isalpha() and w.islower())}  # bytes: of ASCII
        pieces = {p for c in cut.values() for p in c if p not in known and p not in recent}
        pieces.update([w for w in new if w not in cut])
        fresh = self._ids_of(list(pieces))
        for w, c in cut.items():
            fresh[w] = b"".join([fresh.get(p) or known.get(p) or recent[p] for p in c])
        known.update(islice(again.items(), max(0, CACHED - len(known))))
        if len(recent) + len(fresh) > RECENT:
            recent.clear()
        recent.update(islice(fresh.items(), RECENT))
        return again | fresh

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts; long ones go through in parts."""
        if max(map(len, texts), default=0) <= BATCH:
            return self._encode(texts)
        return [np.concatenate([self._encode([p])[0] for p in parts_of(t)]) for t in texts]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        """Words of all texts are cut in one buffer and numbered by Arrow; ids
        are looked up once for each distinct word."""
        import pyarrow as pa
        rows = [(t if OTHER.search(t) else t.lower()).encode("utf-8", "replace") for t in texts]
        buf = np.frombuffer(b"\n".join([b"", *rows, b""]), np.uint8)
        kind = KIND[buf]
        kind[1:][PAIR[buf[:-1].astype(np.uint16) << 8 | buf[1:]]] = LETTER  # the last byte of one
        start = CUT[kind[:-1] * len(KINDS) + kind[1:]]  # of the bytes after the first
        inner = kind[1:] != WHITE
        body, at = buf[1:][inner], np.flatnonzero(start)
        edges = np.append(np.flatnonzero(start[inner]), len(body)).astype(np.int32)
        words = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(edges), pa.py_buffer(body)])
        coded = words.dictionary_encode()
        distinct, code = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        ids = list(map(self.known.get, distinct))
        new = [w for w, x in zip(distinct, ids) if x is None]
        if new:
            fresh = self._learn(new)
            ids = [fresh[w] if x is None else x for w, x in zip(distinct, ids)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(sizes) - sizes
        pool = np.frombuffer(b"".join(ids), np.uint32)
        size = sizes[code]
        end = np.append(0, np.cumsum(size))
        tokens = pool[np.repeat(first[code] - end[:-1], size) + np.arange(end[-1])]
        cuts = end[np.searchsorted(at, np.cumsum([len(r) + 1 for r in rows]))].tolist()
        out = [tokens[lo:hi] for lo, hi in zip([0, *cuts], cuts)]
        for k, t in enumerate(texts):
            if "<|" in t and any(s in t for s in self.special):  # these may hold across the rule
                out[k] = np.array(self.whole.encode(t, add_special_tokens=False).ids, np.uint32)
        return out


def parts_of(text: str) -> Iterator[str]:
    """A long text cut before white space, over which no token reaches."""
    lo = 0
    while len(text) - lo > BATCH and (space := SPACE.search(text, lo + BATCH)):
        yield text[lo:space.start()]
        lo = space.start()
    yield text[lo:]


def cut_stream(ends: np.ndarray, soft: np.ndarray, total: int, window: int = WINDOW) -> list[int]:
    """Cut positions (ascending, the last is ``total``) of a stream of
    ``total`` tokens. ``ends``: positions after documents; ``soft``: positions
    after sentences. Besides these, multiples of ``GRID`` may be cut, so a
    window always fits."""
    if total <= 0:
        return []
    cost = np.full(total + 1, -1.0)
    cost[::GRID] = INNER_CUT
    cost[soft] = SENTENCE_CUT
    cost[ends] = cost[0] = cost[total] = 0.0
    pos = np.flatnonzero(cost >= 0)
    cost = cost[pos]
    where = {p: k for k, p in enumerate(pos.tolist())}
    powers = [1 << k for k in range(window.bit_length()) if 1 << k <= window]
    at, pen = pos.tolist(), cost.tolist()
    best, back = [0.0] * len(at), [0] * len(at)
    queue: deque[int] = deque([0])  # candidates with best + position rising
    for k in range(1, len(at)):
        j = at[k]
        while at[queue[0]] < j - window:
            queue.popleft()
        i = queue[0]
        low, frm = best[i] + at[i] + window - j, i
        if not pen[k]:  # after a document, windows of a power of two as well
            for p in powers:
                i = where.get(j - p, -1)
                if i >= 0 and best[i] < low:
                    low, frm = best[i], i
        best[k], back[k] = low + pen[k] + WINDOW_COST, frm
        key = best[k] + j
        while queue and best[queue[-1]] + at[queue[-1]] >= key:
            queue.pop()
        queue.append(k)
    cuts, k = [], len(at) - 1
    while k:
        cuts.append(at[k])
        k = back[k]
    return cuts[::-1]


OUT = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
       "sequence_id long, offset long")


def pack_stream(docs: Iterator[tuple], encoder: Encoder, part: int, ends_sentence: np.ndarray,
                window: int = WINDOW, chunk: int = CHUNK) -> Iterator[tuple]:
    """Pieces of the documents of one partition, in their order.

    Holds ``chunk`` tokens and one batch of documents at a time: the windows
    chosen over a chunk are given out but for the last, whose tokens start the
    next chunk.
    """
    seq = part << 40
    held: list[list] = []  # [doc_id, ids, start, tokens of the document]

    def flush(final: bool):
        nonlocal held, seq
        ids = np.concatenate([h[1] for h in held]) if held else np.empty(0, np.uint32)
        edge = np.cumsum([len(h[1]) for h in held]) if held else np.empty(0, np.int64)
        whole = [e for e, h in zip(edge.tolist(), held) if h[2] + len(h[1]) == h[3]]
        soft = np.flatnonzero(ends_sentence[ids]) + 1
        cuts = cut_stream(np.array(whole, np.int64), soft, len(ids), window)
        if not final:
            cuts = cuts[:-1]
        out, d, used, lo = [], 0, 0, 0
        for hi in cuts:
            offset = 0
            while lo < hi:
                doc, body, start, tokens = held[d]
                take = min(hi - lo, len(body) - used)
                piece = body[used:used + take]
                out.append((doc, start + used, take, zlib.crc32(piece.astype("<u4").tobytes()), tokens,
                            seq, offset))
                offset, used, lo = offset + take, used + take, lo + take
                if used == len(body):
                    d, used = d + 1, 0
            seq += 1
        rest = held[d:]
        if rest and used:
            doc, body, start, tokens = rest[0]
            rest[0] = [doc, body[used:], start + used, tokens]
        held = rest
        return out

    waiting = 0
    for doc, ids in docs:
        ids = np.append(ids, np.uint32(END_ID))
        for lo in range(0, len(ids), chunk):  # a document longer than a chunk comes in runs
            held.append([doc, ids[lo:lo + chunk], lo, len(ids)])
            waiting += len(held[-1][1])
            if waiting >= chunk:
                yield from flush(False)
                waiting = sum(len(h[1]) for h in held)
    if held:
        yield from flush(True)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per piece: see ``OUT``.

    Documents are dealt into runs by ranges of the id and packed run by run in
    id order, so a run's size does not depend on any key's weight. Null ids
    come first; repeated ids follow each other, ordered by text, and are
    separate documents. A null or empty text is the single id ``END_ID``. An
    empty table gives an empty result. Other columns are not read.
    """
    own_id = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(own_id.alias("doc_id"), text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))  # by the data alone: any cluster packs alike

    kinds = [c.split() for c in OUT.split(", ")]

    def run(batches):
        import os

        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        enc = worker_state("encoder", lambda: Encoder(tokenizer))
        schema = pa.schema([(name, pa.int64()) for name, _ in kinds])

        def stream():
            for b in batches:
                ends = np.cumsum(pc.binary_length(b["text"]).to_numpy())
                runs = np.flatnonzero(np.diff(ends // BATCH)) + 1
                for lo, hi in zip([0, *runs.tolist()], [*runs.tolist(), b.num_rows]):
                    part = b.slice(lo, hi - lo)
                    yield from zip(part["doc_id"].to_pylist(), enc.encode(part["text"].to_pylist()))

        def table_of(pieces: list[tuple]):
            columns = zip(*pieces) if pieces else [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

        buffer = []
        for piece in pack_stream(stream(), enc, TaskContext.get().partitionId(), enc.sentence_end, window):
            buffer.append(piece)
            if len(buffer) >= 10_000:
                yield table_of(buffer)
                buffer = []
        yield table_of(buffer)

    return (rows.repartitionByRange(parts, F.col("doc_id"), F.xxhash64("text"))
            .sortWithinPartitions("doc_id", F.xxhash64("text"))
            .mapInArrow(run, OUT))


def op10_window_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    import public_tokenizers
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def packed(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of the mix."""
    import public_tokenizers
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))
