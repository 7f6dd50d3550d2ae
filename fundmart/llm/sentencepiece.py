"""SentencePiece encoding and decoding on the tokenizers library.

The model file is read on the driver (it is one small file, of a size that does not
depend on the data) and sent to the tasks as bytes. There the protobuf is parsed and its
parts are rebuilt: normaliser (character map, extra spaces, dummy prefix), metaspace
marker, unigram scores or BPE merges, and byte fallback. Batches are encoded with several
threads and decoded again, and the sentencepiece library encodes the same batches;
``parity`` says whether the ids are equal.

SentencePiece joins the pair whose joined piece scores best, the leftmost on a tie. Ranked
merges say the same as long as scores differ. Pieces of equal score, as runs of spaces have,
are ranked by falling length: the leftmost run then grows as far as it can before the next
one begins, which is what the rule of the leftmost comes to. A text is split before its spaces when no piece has a space behind another character: no merge can
cross such a place. With such a model the different words of a batch are coded once and kept
for the next ones (most recent words first, in bounded memory), and the ids of a text with
single spaces between its words are those of its words, one after the other; its parity is that
of its words, each of which both libraries have coded. All other texts are coded and compared
whole. Every text is decoded from its own ids and then compared with the input.

Defined results: a null or empty text has no ids and decodes to an empty text. A marker
character in the text decodes to a space, as in SentencePiece itself; ``round_trip``
compares with the text read that way. A very long text is a batch of its own. Extra columns are ignored; repeated rows give
repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from fundmart.llm.base import named, query, table, text_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
THREADS = 2
# Texts are encoded in batches of so many characters: an encoding takes far more memory.
BATCH_CHARS = 400_000
# Words kept from batch to batch (twice as many at most), of at most so many characters each.
KNOWN_WORDS = 60_000
KNOWN_CHARS = 100
WORDS_TOGETHER = 100
MARK = "▁"

# Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2

SCHEMA = (
    "doc_id long, n_tokens int, ids array<int>, decoded string, round_trip boolean, parity boolean"
)


def _fields(message: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and raw values of one protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            value: object = varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            value = message[at : at + size]
            at += size
        yield key >> 3, value


@dataclass
class Model:
    """What the protobuf says."""

    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    char_map: bytes = b""
    dummy_prefix: bool = True
    one_space: bool = True


def parse_model(data: bytes) -> Model:
    model = Model()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            model.pieces.append(piece.get(1, b"").decode("utf-8"))
            model.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            model.kinds.append(piece.get(3, NORMAL))
        elif number == 2:
            trainer = dict(_fields(value))
            model.model_type = trainer.get(3, UNIGRAM)
            model.byte_fallback = bool(trainer.get(35, 0))
        elif number == 3:
            normaliser = dict(_fields(value))
            model.char_map = normaliser.get(2, b"")
            model.dummy_prefix = bool(normaliser.get(3, 1))
            model.one_space = bool(normaliser.get(4, 1))
    return model


def _merges(model: Model) -> list[tuple[str, str]]:
    """Pairs in the order in which SentencePiece prefers them."""
    usable = {
        piece: -score
        for piece, score, kind in zip(model.pieces, model.scores, model.kinds, strict=True)
        if kind in (NORMAL, USER_DEFINED, UNUSED)
    }
    ranked = []
    for piece, cost in usable.items():
        for cut in range(1, len(piece)):
            if piece[:cut] in usable and piece[cut:] in usable:
                ranked.append((cost, -len(piece), piece, cut))
    return [(piece[:cut], piece[cut:]) for _, _, piece, cut in sorted(ranked)]


def splits_at_spaces(model: Model) -> bool:
    """No piece has a space behind another character."""
    pieces = zip(model.pieces, model.kinds, strict=True)
    return not any(MARK in p.lstrip(MARK) for p, k in pieces if k in (NORMAL, USER_DEFINED))


def build_tokenizer(data: bytes):
    """A tokenizer of the tokenizers library that does what the model file says."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    model = parse_model(data)
    unknown = model.kinds.index(UNKNOWN)
    if model.model_type == BPE:
        core = models.BPE(
            vocab={piece: i for i, piece in enumerate(model.pieces)},
            merges=_merges(model),
            unk_token=model.pieces[unknown],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
            # Words are kept here, not in the library.
            cache_capacity=0 if splits_at_spaces(model) else 10_000,
        )
    elif model.model_type == UNIGRAM:
        core = models.Unigram(
            list(zip(model.pieces, model.scores, strict=True)), unknown, model.byte_fallback
        )
    else:
        raise ValueError(f"model type {model.model_type} is neither unigram nor BPE")
    tokenizer = Tokenizer(core)

    steps = []
    if model.char_map:
        steps.append(normalizers.Precompiled(model.char_map))
    if model.one_space:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)

    if splits_at_spaces(model):
        words = Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        tokenizer.pre_tokenizer = pre_tokenizers.Split(words, "isolated")

    undo = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        undo.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(undo)
    return tokenizer


def _batches(texts: pa.Array) -> Iterator[slice]:
    start = size = 0
    for i, length in enumerate(pc.binary_length(texts).to_pylist()):
        if size and size + length > BATCH_CHARS:
            yield slice(start, i)
            start, size = i, 0
        size += length
    if start < len(texts):
        yield slice(start, len(texts))


class _Coder:
    """Both encoders of one task."""

    def __init__(self, data: bytes, threads: int) -> None:
        import sentencepiece

        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        self.threads = threads
        self.model = parse_model(data)
        self.tokenizer = build_tokenizer(data)
        self.check = sentencepiece.SentencePieceProcessor(model_proto=data)
        plain = not self.model.char_map and not self.model.one_space
        self.by_word = plain and self.model.dummy_prefix and splits_at_spaces(self.model)
        if self.by_word:
            from tokenizers import Tokenizer, pre_tokenizers

            # Words bring their markers along: nothing is left to rewrite.
            self.word_tokenizer = Tokenizer(self.tokenizer.model)
            self.word_tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(
                MARK, prepend_scheme="never", split=True
            )
            self.begins = np.array([p.startswith(MARK) for p in self.model.pieces])
            pieces = [
                bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(MARK, " ").encode()
                for p, k in zip(self.model.pieces, self.model.kinds, strict=True)
            ]
            # All pieces in a row, and where each of them begins.
            self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
            self.piece_sizes = np.array([len(p) for p in pieces], np.int32)
            self.piece_starts = np.cumsum(self.piece_sizes) - self.piece_sizes
        # Ids as 32-bit integers; words on which the libraries differ are noted.
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.unequal: set[str] = set()

    def code(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str, bool, bool]]:
        """Ids, decoded text, round trip and parity of each text."""
        words = [self._words(t) for t in texts]
        self._learn({w for own in words if own for w in own})
        known, unequal = self.recent, self.unequal
        put = [
            np.frombuffer(b"".join([known[w] for w in own]), np.int32) for own in words if own
        ]
        joined = zip(put, self._decoded(put), strict=True)
        whole = self._whole([t for t, own in zip(texts, words, strict=True) if not own])
        for text, own in zip(texts, words, strict=True):
            if own:
                ids, back = next(joined)
                equal = not unequal or unequal.isdisjoint(own)
            else:
                ids, back, equal = next(whole)
            yield ids, back, back == self._plain(text), equal

    def _decoded(self, coded: list[np.ndarray]) -> list[str]:
        """The text of each list of ids."""
        if not coded:
            return []
        ids = np.concatenate(coded)
        sizes = self.piece_sizes[ids]
        ends = np.cumsum(sizes, dtype=np.int64)
        # For each byte its place among all pieces: its piece's start and its distance from there.
        places = np.repeat((self.piece_starts[ids] - (ends - sizes)).astype(np.int32), sizes)
        places += np.arange(len(places), dtype=np.int32)
        data = self.piece_bytes[places].tobytes()
        bounds = ends[np.cumsum([len(c) for c in coded]) - 1].tolist()
        # The space before the first word is the model's, not the text's.
        return [
            data[a:b].decode("utf-8", "replace").removeprefix(" ")
            for a, b in zip([0, *bounds], bounds, strict=False)
        ]

    def _words(self, text: str) -> list[str] | None:
        """The words of a text that may be put together from them; None: it may not."""
        if not self.by_word or not text or MARK in text:
            return None
        words = text.split(" ")
        return None if "" in words else words

    def _learn(self, different: set[str]) -> None:
        """Code the words that are not known; afterwards all of them are in ``recent``."""
        if len(self.recent) > KNOWN_WORDS:
            self.older = {
                w: ids
                for w, ids in self.recent.items()
                if len(w) <= KNOWN_CHARS and w not in self.unequal
            }
            self.recent = {}
            self.unequal.clear()
        new = []
        for word in different.difference(self.recent):
            ids = self.older.get(word)
            if ids is None:
                new.append(word)
            else:
                self.recent[word] = ids
        expected = self.check.encode(new, num_threads=self.threads)
        for word, ids, other in zip(new, self._word_ids(new), expected, strict=True):
            self.recent[word] = ids
            if np.frombuffer(ids, np.int32).tolist() != other:
                self.unequal.add(word)

    def _word_ids(self, words: list[str]) -> Iterator[bytes]:
        """Ids of each word, many words to a text: pieces with a marker begin a word."""
        texts = [
            MARK + MARK.join(words[i : i + WORDS_TOGETHER])
            for i in range(0, len(words), WORDS_TOGETHER)
        ]
        for encoding in self.word_tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(encoding.ids, np.int32)
            bounds = [*np.flatnonzero(self.begins[ids]).tolist(), len(ids)]
            data = ids.tobytes()
            for a, b in zip(bounds, bounds[1:], strict=False):
                yield data[4 * a : 4 * b]

    def _whole(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str, bool]]:
        if not texts:
            return
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = [e.ids for e in encoded]
        decoded = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        expected = self.check.encode(texts, num_threads=self.threads)
        for own, back, other in zip(ids, decoded, expected, strict=True):
            yield np.array(own, np.int32), back, own == other

    def _plain(self, text: str) -> str:
        """The text as a round trip may return it."""
        if self.model.char_map or self.model.one_space:
            text = self.check.normalize(text)
            text = text.removeprefix(MARK) if self.model.dummy_prefix else text
        return text.replace(MARK, " ")


def encode_decode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model_path: str = MODEL,
    threads: int = THREADS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: ids, their number, the decoded text, and both verdicts.

    Columns named in ``keep`` are passed on.
    """
    with open(model_path, "rb") as file:
        data = file.read()
    shared = docs.sparkSession.sparkContext.broadcast(data)
    schema = docs.select(*[named(c) for c in keep]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A coder ends with its task: a worker that kept it would keep one for every call.
        coder = None
        for batch in batches:
            coder = coder or _Coder(shared.value, threads)
            texts = batch.column("own_text")
            for part in _batches(texts):
                rows = list(coder.code(texts[part].to_pylist()))
                passed = batch.slice(part.start, part.stop - part.start)
                lengths = np.array([len(row[0]) for row in rows], np.int32)
                ids = np.concatenate([row[0] for row in rows])
                bounds = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
                columns = [
                    passed.column("own_id"),
                    pa.array(lengths),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids)),
                    *[pa.array([row[k] for row in rows]) for k in (1, 2, 3)],
                    *[passed.column(f"keep_{i}") for i in range(len(keep))],
                ]
                names = ["doc_id", "n_tokens", "ids", "decoded", "round_trip", "parity", *keep]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(
        named(id_col).cast("long").alias("own_id"),
        text_of(text_col).alias("own_text"),
        *[named(c).alias(f"keep_{i}") for i, c in enumerate(keep)],
    )
    passed = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in schema)
    return rows.mapInArrow(run, SCHEMA + passed)


@query()
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return encode_decode(table(spark, folder, "documents"))
