"""SentencePiece byte-fallback BPE in numpy merge rounds.

Texts are cut into words that no vocabulary piece can span, so a word's
pieces do not depend on its neighbours.  The distinct new words of a batch are
encoded together as one flat array of symbols: each round finds the smallest
pair rank of every word, merges the pairs that have it from the left, and
compacts, until no pair is left.  Model file and its vocabulary are a
parameter; nothing is trained.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SPACE = "▁"      # SentencePiece's mark of a space (fixed value)
MEMO_WORDS = 500_000  # words a task keeps encoded, at most
NO_RANK = np.int64(1 << 60)
UNKNOWN = 1 << 24     # symbols from here on are characters outside the vocabulary

RESULT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Vocabulary:
    """Pieces of a byte-fallback BPE model with identity normalisation."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor
        sp = SentencePieceProcessor(model_proto=model)
        n = sp.vocab_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        byte = [i for i in range(n) if sp.is_byte(i)]
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.byte_id = {int(self.pieces[i][3:5], 16): i for i in byte}
        self.id_byte = {i: b for b, i in self.byte_id.items()}
        self.plain = {self.pieces[i]: i for i in plain}
        if len(self.byte_id) != 256 or any(SPACE in p.lstrip(SPACE) for p in self.plain):
            raise ValueError("a byte-fallback model whose pieces hold spaces at their start only is needed")
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in plain}, reverse=True))}
        pairs = {}
        for piece, i in self.plain.items():
            for cut in range(1, len(piece)):
                a, b = self.symbol(piece[:cut]), self.symbol(piece[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = (order[sp.get_score(i)], i)
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()] + [NO_RANK], np.int64)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()] + [0], np.int64)

    def symbol(self, part: str) -> int | None:
        return self.plain.get(part, UNKNOWN + ord(part) if len(part) == 1 else None)

    def pair_at(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair in ``ranks``; the last place if it has none."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at, len(self.keys))


def _merge(vocab: Vocabulary, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and word numbers after all merges, words in their order."""
    done_sym, done_word = [], []
    at = np.full(len(sym), len(vocab.keys))  # of the pair that starts at each symbol
    same = np.flatnonzero(word[:-1] == word[1:])
    at[same] = vocab.pair_at(sym[same], sym[same + 1])
    while len(sym):
        rank = vocab.ranks[at]
        start = np.r_[True, word[1:] != word[:-1]]
        group = np.cumsum(start) - 1
        least = np.minimum.reduceat(rank, np.flatnonzero(start))
        open_ = (least < NO_RANK)[group]
        if not open_.all():
            done_sym.append(sym[~open_])
            done_word.append(word[~open_])
            sym, word, rank, at, group = sym[open_], word[open_], rank[open_], at[open_], group[open_]
            if not len(sym):
                break
        hit = np.flatnonzero(rank == least[group])
        # In a run of overlapping pairs every other one merges.
        joins = np.r_[False, np.diff(hit) == 1]
        run = np.maximum.accumulate(np.where(joins, 0, np.arange(len(hit))))
        hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
        merged = _merged(vocab, sym, word, at, hit)
        # Merging all of them at once is the same as one by one unless a new
        # pair would have gone first; such words merge their leftmost only.
        early = np.zeros(len(least), bool)
        for new, by in merged[3]:
            late = vocab.ranks[merged[2][new]] <= least[group[hit[by]]]
            early[group[hit[by[late]]]] = True
        if early.any():
            g = group[hit]
            hit = hit[np.r_[True, g[1:] != g[:-1]] | ~early[g]]
            merged = _merged(vocab, sym, word, at, hit)
        sym, word, at = merged[:3]
    if not done_sym:
        return sym, word
    sym, word = np.concatenate(done_sym), np.concatenate(done_word)
    order = np.argsort(word, kind="stable")
    return sym[order], word[order]


def _merged(vocab, sym, word, at, hit):
    """Symbols, words and pairs after the merges at ``hit``; of the new pairs,
    the places and which merge made them."""
    out, keep = sym.copy(), np.ones(len(sym), bool)
    out[hit] = vocab.merged[at[hit]]
    keep[hit + 1] = False
    out, word, at = out[keep], word[keep], at[keep]
    place, made = hit - np.arange(len(hit)), []
    for left in (place - 1, place):
        by = np.flatnonzero((left >= 0) & (left + 1 < len(out)))
        by = by[word[left[by]] == word[left[by] + 1]]
        new = left[by]
        at[new] = vocab.pair_at(out[new], out[new + 1])
        made.append((new, by))
    at[place[word[place] != word[np.minimum(place + 1, len(out) - 1)]]] = len(vocab.keys)
    at[-1] = len(vocab.keys)
    return out, word, at, made


class Encoder:
    """Encodes and decodes texts, remembering words within a task."""

    WORDS = re.compile(" *[^ \n]+|\n| +")

    def __init__(self, model: bytes, memo_words: int = MEMO_WORDS):
        self.vocab, self.memo_words = Vocabulary(model), memo_words
        self.count, self.ids, self.decoded = {}, {}, {}
        self.shown = [p.replace(SPACE, " ") for p in self.vocab.pieces]
        self.number = [str(i) for i in range(len(self.shown))]

    def words(self, text: str) -> list[str]:
        """Parts of a text that pieces do not span, spaces as in the model."""
        return self.WORDS.findall((" " + text).replace(SPACE, " ")) if text else []

    def pieces_of(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, by merge rounds over all words at once."""
        parts = [w.replace(" ", SPACE) for w in words]
        points = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32).astype(np.int64)
        distinct, where = np.unique(points, return_inverse=True)
        sym = np.array([self.vocab.symbol(chr(c)) for c in distinct.tolist()], np.int64)[where]
        owner = np.repeat(np.arange(len(parts)), np.fromiter(map(len, parts), np.int64, len(parts)))
        sym, owner = _merge(self.vocab, sym, owner)
        ends = np.searchsorted(owner, np.arange(len(parts)), side="right")
        flat, out, start = sym.tolist(), [], 0
        unknown = {s: [self.vocab.byte_id[b] for b in chr(s - UNKNOWN).encode("utf-8")] for s in set(flat) if s >= UNKNOWN}
        for end in ends.tolist():
            ids = flat[start:end]
            out.append([i for s in ids for i in unknown.get(s, (s,))] if unknown else ids)
            start = end
        return out

    def learn(self, words: Iterable[str]) -> None:
        new = [w for w in words if w not in self.ids]
        if len(self.ids) + len(new) > self.memo_words:
            self.count, self.ids, self.decoded = {}, {}, {}
            new = list(words)
        if new:
            number = self.number.__getitem__
            for w, ids in zip(new, self.pieces_of(new), strict=True):
                self.count[w], self.ids[w], self.decoded[w] = len(ids), ",".join(map(number, ids)), self.text_of(ids)

    def text_of(self, ids: list[int]) -> str:
        """The pieces' text, a leading mark of a space included; a run of byte
        pieces is read as UTF-8."""
        byte = self.vocab.id_byte
        if byte.keys().isdisjoint(ids):
            return "".join(map(self.shown.__getitem__, ids))
        out, raw = [], bytearray()
        for i in ids:
            if i in byte:
                raw.append(byte[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw = bytearray()
            out.append(self.shown[i])
        return "".join(out) + raw.decode("utf-8", "replace")

    def encode_words(self, texts: list[str]) -> list[list[str]]:
        split = [self.words(t) for t in texts]
        self.learn({w for ws in split for w in ws})
        return split

    def encode(self, text: str) -> list[int]:
        words = self.encode_words([text])[0]
        return [int(i) for w in words for i in self.ids[w].split(",")]

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the space put before every text goes."""
        return self.text_of(ids).removeprefix(" ")


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def _chunks(texts: list[str], limit: int = 2_000_000):
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if texts:
        yield start, len(texts)


def _task(model, lengths_only: bool):
    def run(batches):
        encoder = Encoder(model.value)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _chunks(texts):
                split = encoder.encode_words(texts[a:b])
                counts = [sum(map(encoder.count.__getitem__, ws)) for ws in split]
                out = {"doc_id": pa.array(ids[a:b], pa.int64()), "n_tokens": pa.array(counts, pa.int64())}
                if not lengths_only:
                    out["ids_sha256"] = pa.array([_digest(",".join(map(encoder.ids.__getitem__, ws))) for ws in split], pa.string())
                    out["decoded_sha256"] = pa.array(
                        [_digest("".join(map(encoder.decoded.__getitem__, ws)).removeprefix(" ")) for ws in split], pa.string())
                for name, column in zip(batch.schema.names[2:], batch.columns[2:], strict=True):
                    out[name] = column.slice(a, b - a)
                yield pa.RecordBatch.from_pydict(out)
    return run


def _model_for(spark: SparkSession, path: str | None):
    # The vocabulary's size is a property of the model file (0.5 MB here).
    return spark.sparkContext.broadcast(read_model(path or default_model()))


def encode_report(docs: DataFrame, model_path: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, and
    the columns ``keep``, in the order of the rows of each partition.

    Null text counts as empty: no tokens, digests of the empty string.  Rows
    that repeat a doc_id are encoded one by one; other columns are ignored.
    """
    model = _model_for(docs.sparkSession, model_path)
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"], *keep)
    return rows.mapInArrow(_task(model, False), T.StructType(RESULT.fields + [docs.schema[c] for c in keep]))


def token_lengths(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id and n_tokens of every document, null text as empty."""
    model = _model_for(docs.sparkSession, model_path)
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"])
    return rows.mapInArrow(_task(model, True), T.StructType(RESULT.fields[:2]))


def encode(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, ids and decoded text of every document."""
    model = _model_for(docs.sparkSession, model_path)

    def run(batches):
        encoder = Encoder(model.value)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _chunks(texts):
                ids = [[int(i) for w in ws for i in encoder.ids[w].split(",")] for ws in encoder.encode_words(texts[a:b])]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(keys[a:b], pa.int64()), "ids": pa.array(ids, pa.list_(pa.int32())),
                                                  "decoded": pa.array([encoder.decode(i) for i in ids], pa.string())})
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"])
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>, decoded string")
