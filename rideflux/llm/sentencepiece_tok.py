"""SentencePiece models on the tokenizers library: encode, decode, parity.

The model file is parsed as protobuf here (wire format only) and rebuilt as a
``tokenizers.Tokenizer``: normaliser (compiled character map, extra spaces),
the metaspace marker, unigram scores or BPE merges, byte fallback.

Whole texts are encoded exactly and fast by cutting them where no piece can
cross: before a marker that follows another character, around a line break, and
before a full stop or comma that follows a letter, provided that no piece of
the model holds such a pair of characters (checked when the model is built).
Each distinct segment is encoded once, in multithreaded batches, checked
against the sentencepiece library and kept in a bounded cache.  With a model
that normalises or cannot be cut so, whole original texts are checked.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rideflux.llm.common import ship

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# Fixed values of the model file: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Segments that a worker remembers, characters that it segments at once, and
#: threads of an encoding batch.
CACHE = 300_000
SLICE = 1 << 20
THREADS = 2
#: Characters of segments encoded as one text, a line each.
LINES = 1 << 16
#: Letters after which a full stop or comma starts a segment, if no piece has such a pair.
LETTER = "[a-zA-ZÀ-ÖØ-öø-ÿ]"


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; varints unsigned."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            if kind != 2:
                raise ValueError(f"wire type {kind} in a model file")
            size = varint()
        if at + size > len(data):
            raise ValueError("truncated model file")
        yield tag >> 3, data[at:at + size]
        at += size


@dataclass
class ModelFile:
    pieces: list[tuple[str, float, int]]
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True
    whitespace_as_suffix: bool = False


def parse_model(data: bytes) -> ModelFile:
    """Pieces and the settings that encoding needs, with the format's defaults."""
    out = ModelFile([])
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            out.pieces.append((piece.get(1, b"").decode("utf-8"), score, piece.get(3, NORMAL)))
        elif number == 2:
            spec = dict(_fields(value))
            out.model_type = spec.get(3, UNIGRAM)
            out.byte_fallback = bool(spec.get(35, 0))
            out.whitespace_as_suffix = bool(spec.get(24, 0))
        elif number == 3:
            spec = dict(_fields(value))
            out.charsmap = spec.get(2, b"")
            out.add_dummy_prefix = bool(spec.get(3, 1))
            out.remove_extra_whitespaces = bool(spec.get(4, 1))
            out.escape_whitespaces = bool(spec.get(5, 1))
    unknown = [i for i, p in enumerate(out.pieces) if p[2] == UNKNOWN]
    if len(unknown) != 1:
        raise ValueError("a model has exactly one unknown piece")
    out.unk_id = unknown[0]
    return out


def build_tokenizer(model: ModelFile):
    """The ``tokenizers.Tokenizer`` of a unigram or BPE model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if model.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models")
    if not model.escape_whitespaces or model.whitespace_as_suffix:
        raise ValueError("only models with the marker in front of words")
    if model.model_type == UNIGRAM:
        # A piece that is not ordinary text never wins the best path.
        low = min((s for _, s, _ in model.pieces), default=0.0) - 1e6
        vocab = [(p, s if t in (NORMAL, USER_DEFINED) else low) for p, s, t in model.pieces]
        core = models.Unigram(vocab, unk_id=model.unk_id, byte_fallback=model.byte_fallback)
    else:
        plain = {p: s for p, s, t in model.pieces if t in (NORMAL, USER_DEFINED)}
        by_score = sorted(plain, key=lambda p: -plain[p])
        merges = [(p[:k], p[k:]) for p in by_score for k in range(1, len(p)) if p[:k] in plain and p[k:] in plain]
        core = models.BPE({p: i for i, (p, _, _) in enumerate(model.pieces)}, merges, fuse_unk=True,
                          unk_token=model.pieces[model.unk_id][0], byte_fallback=model.byte_fallback)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.add_dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    steps.append(normalizers.Replace(" ", MARK))
    tok = Tokenizer(core)
    tok.normalizer = normalizers.Sequence(steps)
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.add_dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    tok.decoder = decoders.Sequence(back)
    return tok


class Codec:
    """Encoder and decoder of one model in one worker."""

    def __init__(self, data: bytes, verify: bool = True):
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        import sentencepiece
        from tokenizers.pre_tokenizers import Split

        self.model = parse_model(data)
        self.tok = build_tokenizer(self.model)
        self.raw = build_tokenizer(self.model)
        self.raw.normalizer = None
        plain = not self.model.charsmap and not self.model.remove_extra_whitespaces
        self.normalise = self._simple if plain else self.tok.normalizer.normalize_str
        ordinary = [p for p, _, t in self.model.pieces if t in (NORMAL, USER_DEFINED)]
        crossing = any(MARK in p.lstrip(MARK) for p in ordinary) or any("\n" in p for p in ordinary)
        # Unknowns fuse across cuts; only byte fallback leaves none.
        self.exact = not crossing and self.model.byte_fallback
        if not self.exact:
            self.cut = re.compile(r"(?s).+")
        elif any(re.search(f"{LETTER}[.,]", p) for p in ordinary):
            self.cut = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
        else:
            run = f"(?:[^{MARK}\n.,]|(?<!{LETTER})[.,])"
            self.cut = re.compile(f"{MARK}*{run}+|[.,]{run}*|{MARK}+|\n")
        if self.exact:
            self.raw.pre_tokenizer = Split("\n", "isolated")
        library = sentencepiece.SentencePieceProcessor(model_proto=data) if verify else None
        # Segments show parity only where normalisation is the plain replacement of spaces.
        self.verify, self.whole = (library, None) if self.exact and plain else (None, library)
        self.cache: dict[str, bytes] = {}
        self.broken: set[str] = set()  # segments that fail parity
        self.table = [b"" if t in (CONTROL, UNKNOWN) else bytes([int(p[3:5], 16)]) if t == BYTE
                      else p.replace(MARK, " ").encode("utf-8") for p, _, t in self.model.pieces]
        self.table[self.model.unk_id] = " ⁇ ".encode("utf-8")

    def _simple(self, text: str) -> str:
        if not text:
            return ""
        return (MARK if self.model.add_dummy_prefix else "") + text.replace(" ", MARK)

    def _slices(self, text: str) -> Iterator[str]:
        """Pieces of a normalised text cut where segments end anyway."""
        at = 0
        while self.exact and len(text) - at > SLICE:
            end = at + SLICE
            while end < len(text) and not (text[end] == MARK and text[end - 1] != MARK or text[end] == "\n"):
                end += 1
            yield text[at:end]
            at = end
        yield text[at:]

    def _learn(self, segments: set[str]) -> None:
        new = [s for s in segments if s not in self.cache]
        if not new:
            return
        if len(self.cache) + len(new) > CACHE:
            self.cache.clear()
            new = list(segments)
        if not self.exact:
            for s, e in zip(new, self.raw.encode_batch_fast(new, add_special_tokens=False)):
                self.cache[s] = np.array(e.ids, np.int32).tobytes()
            return
        # Many segments make one text, a line each: a call costs more than a segment.
        lines = [s for s in new if s != "\n"]
        blocks, size = [[]], 0
        for s in lines:
            if size > LINES:
                blocks.append([])
                size = 0
            blocks[-1].append(s)
            size += len(s) + 1
        texts = ["\n" + "\n".join(b) for b in blocks]
        found = [np.array(e.ids, np.int32) for e in self.raw.encode_batch_fast(texts, add_special_tokens=False)]
        end_of_line = found[0][:1].tobytes() if lines else np.array(
            self.raw.encode("\n", add_special_tokens=False).ids, np.int32).tobytes()
        self.cache["\n"] = end_of_line
        if not lines:
            return
        if self.verify:
            expected = self.verify.encode([t.replace(MARK, " ") for t in texts], num_threads=THREADS)
            lead = len(self.verify.encode("\n")) - 1  # the marker in front of a text
        for k, (block, ids) in enumerate(zip(blocks, found)):
            starts = np.flatnonzero(ids == found[0][0])
            ends = np.r_[starts[1:], len(ids)]
            raw = ids.tobytes()
            for s, a, b in zip(block, ((starts + 1) * 4).tolist(), (ends * 4).tolist()):
                self.cache[s] = raw[a:b]
            if self.verify and ids.tolist() != expected[k][lead:]:
                other = self.verify.encode(["\n" + s.replace(MARK, " ") for s in block])
                self.broken.update(s for s, e in zip(block, other)
                                   if np.array(e[lead + 1:], np.int32).tobytes() != self.cache[s])

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[np.ndarray, bool]]:
        """Token ids of each text and whether it (or all its segments) has parity."""
        for text in texts:
            parts, good = [], True
            for piece in self._slices(self.normalise(text)):
                segments = self.cut.findall(piece)
                if not segments:
                    continue
                distinct = set(segments)
                self._learn(distinct)
                parts.append(b"".join(map(self.cache.__getitem__, segments)))
                good = good and self.broken.isdisjoint(distinct)
            ids = np.frombuffer(b"".join(parts), np.int32)
            yield ids, good and self._same(text, ids)

    def _same(self, text: str, ids: np.ndarray) -> bool:
        """Whether the library gives the whole text these ids, where it is asked."""
        return self.whole is None or self.whole.encode(text) == ids.tolist()

    def encode_group(self, texts: list[str]) -> Iterator[tuple[np.ndarray, bool]]:
        """Like ``encode``; new segments of the whole group go in one batch."""
        if sum(map(len, texts)) <= 2 * SLICE:
            split = [self.cut.findall(self.normalise(t)) for t in texts]
            self._learn(set().union(*split))
            get = self.cache.__getitem__
            for text, segments in zip(texts, split):
                good = not self.broken or self.broken.isdisjoint(segments)
                ids = np.frombuffer(b"".join(map(get, segments)), np.int32)
                yield ids, good and self._same(text, ids)
        else:
            yield from self.encode(texts)

    def decode(self, ids: np.ndarray) -> str:
        data = b"".join(map(self.table.__getitem__, ids.tolist()))
        if self.model.add_dummy_prefix and data[:1] == b" ":
            data = data[1:]
        return data.decode("utf-8", "replace")


_CODECS: dict[bytes, Codec] = {}


def _codec(data: bytes) -> Codec:
    if data not in _CODECS:
        _CODECS.clear()
        _CODECS[data] = Codec(data)
    return _CODECS[data]


def groups(texts: list[str | None]) -> Iterator[list[str]]:
    """Consecutive texts of together at most ``SLICE`` characters (one at least)."""
    held, size = [], 0
    for t in texts:
        t = t or ""
        if held and size + len(t) > SLICE:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def _encode(batches: Iterator[pa.RecordBatch], data: bytes) -> Iterator[pa.RecordBatch]:
    codec = _codec(data)
    for b in batches:
        at = 0
        for texts in groups(b.column(1).to_pylist()):
            ids, parity, same = [], [], []
            for text, (found, good) in zip(texts, codec.encode_group(texts)):
                ids.append(found)
                parity.append(good)
                same.append(codec.decode(found) == text)
            n = np.array([len(x) for x in ids], np.int64)
            flat = pa.array(np.concatenate(ids) if len(ids) else np.empty(0, np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(at, len(texts)),
                 pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), flat),
                 pa.array(n), pa.array(parity), pa.array(same)],
                ["doc_id", "ids", "n_tokens", "parity", "round_trip"])
            at += len(texts)


def encode(docs: DataFrame, model: str = DEFAULT_MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, n_tokens, parity, round_trip`` for every row of ``docs``.

    ``parity``: the ids equal the sentencepiece library's; ``round_trip``:
    they decode to exactly the text (a model that normalises texts loses
    some).  Null and empty texts have no token.  Ids of rows are only carried.
    ``model`` is read on the driver and sent to the workers (vocabularies are
    a few megabytes); other columns are not read.  Repeated rows each get their
    own result, an empty table gives no rows; a very long text is encoded in
    segments that no piece crosses, work and memory grow with it.
    """
    ship(docs.sparkSession)
    with open(model, "rb") as f:
        data = f.read()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(partial(_encode, data=data), f"doc_id {kind}, ids array<int>, n_tokens long, "
                           "parity boolean, round_trip boolean")


def _decode(batches: Iterator[pa.RecordBatch], data: bytes) -> Iterator[pa.RecordBatch]:
    codec = _codec(data)
    for b in batches:
        texts = [None if x is None else codec.decode(np.array(x, np.int64)) for x in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])


def decode(tokens: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give a null text."""
    ship(tokens.sparkSession)
    with open(model, "rb") as f:
        data = f.read()
    kind = dict(tokens.dtypes)["doc_id"]
    return tokens.select("doc_id", "ids").mapInArrow(partial(_decode, data=data), f"doc_id {kind}, text string")
