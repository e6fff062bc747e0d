"""SentencePiece BPE encoding and decoding by vectorised merge rounds."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirewave.llm.common import table
from hirewave.session import ship_package

MODEL = "piece_bpe_32k.model"
CACHE_WORDS = 150_000
_SPACE = "▁"
_NONE = np.iinfo(np.int32).max


class Vocabulary:
    """Pieces of a BPE model with byte fallback, as lookup tables.

    ``pieces`` is a list of (piece, score, kind) with kind ``normal``,
    ``byte``, ``control`` or ``unknown``, in id order.
    """

    def __init__(self, pieces: list[tuple[str, float, str]], bos: int, eos: int) -> None:
        self.bos, self.eos = bos, eos
        normal = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == "normal"}
        self.byte_ids = [next((i for i, (p, _, k) in enumerate(pieces) if k == "byte" and p == f"<0x{b:02X}>"), None)
                         for b in range(256)]
        if None in self.byte_ids:
            raise ValueError("the model has no byte fallback")
        if any(_SPACE in p.lstrip(_SPACE) for p in normal):
            raise ValueError("pieces that go on after a word's end are not supported")
        inner = sorted({c for p in normal if len(p) > 1 for c in p} - set(normal))
        #: symbol -> text; ids of normal pieces, then characters that only occur inside pieces, then "other"
        symbols = normal | {c: len(pieces) + i for i, c in enumerate(inner)}
        self.other = len(pieces) + len(inner)
        self.size = self.other + 1
        self.n_pieces = len(pieces)
        self.char_symbol = np.full(0x110000, self.other, dtype=np.int32)
        for s, i in symbols.items():
            if len(s) == 1:
                self.char_symbol[ord(s)] = i
        order = {s: r for r, s in enumerate(sorted({pieces[i][1] for i in normal.values()}, reverse=True))}
        rank = np.full(self.size, _NONE, dtype=np.int32)
        for i in normal.values():
            rank[i] = order[pieces[i][1]]
        pairs = [(symbols[p[:k]] * self.size + symbols[p[k:]], i) for p, i in normal.items()
                 for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols]
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs] + [np.iinfo(np.int64).max], dtype=np.int64)
        self.pair_piece = np.array([p for _, p in pairs] + [0], dtype=np.int32)
        self.pair_rank = np.append(rank[self.pair_piece[:-1]], _NONE)
        #: pieces after whose merge a neighbour may merge at once: those merge one place a round
        self.one_by_one = np.zeros(self.size, dtype=bool)
        for k, p in pairs:
            for part in divmod(k, self.size):
                if rank[p] <= rank[part]:
                    self.one_by_one[part] = True
        shut = "".join(re.escape(chr(c)) for c in range(32) if not any(chr(c) in p and len(p) > 1 for p in normal))
        self.words = re.compile(f" *[^ {shut}]+| +|[{shut}]" if shut else " *[^ ]+| +")
        self.bytes_of = [p.replace(_SPACE, " ").encode() if k == "normal" else bytes([int(p[3:5], 16)]) if k == "byte"
                         else " ⁇ ".encode() if k == "unknown" else b"" for p, _, k in pieces]
        self.leads = np.array([k == "normal" and p.startswith(_SPACE) for p, _, k in pieces])

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        return cls(*read_model(path))

    # encoding

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word (little-endian 32-bit), all words at once."""
        if not words:
            return []
        text = "".join(words).replace(" ", _SPACE)
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        sym = self.char_symbol[chars]
        lengths = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words)), lengths)
        at = np.arange(len(sym))  # first character of each symbol
        done: list[tuple[np.ndarray, ...]] = []
        while len(sym):
            same = word[1:] == word[:-1]
            keys = np.where(same, sym[:-1].astype(np.int64) * self.size + sym[1:], -1)
            spot = np.searchsorted(self.pair_keys, keys)
            hit = self.pair_keys[spot] == keys
            rank = np.append(np.where(hit, self.pair_rank[spot], _NONE), _NONE).astype(np.int32)
            first = np.flatnonzero(np.append(True, ~same))
            best = np.minimum.reduceat(rank, first)
            run = np.cumsum(np.append(False, ~same))  # running number of the word
            mine = best[run]
            over = mine == _NONE
            if over.any():
                done.append((word[over], at[over], sym[over]))
            take = (rank == mine) & ~over
            piece = self.pair_piece[np.append(spot, len(self.pair_keys) - 1)]
            spots = np.flatnonzero(take)
            if len(spots):
                single = self.one_by_one[piece[spots]]
                lead = np.append(True, run[spots][1:] != run[spots][:-1])
                lone = np.zeros(len(first), dtype=bool)
                lone[run[spots][single]] = True
                spots = spots[~lone[run[spots]] | lead]
                # of places that overlap, take every second from the left
                start = np.append(True, spots[1:] != spots[:-1] + 1)
                begin = np.maximum.accumulate(np.where(start, spots, 0))
                spots = spots[(spots - begin) % 2 == 0]
                sym = sym.copy()
                sym[spots] = piece[spots]
                stay = ~over
                stay[spots + 1] = False
            else:
                stay = ~over
            word, at, sym = word[stay], at[stay], sym[stay]
        word, at, sym = (np.concatenate(x) for x in zip(*done))
        order = np.lexsort((at, word))
        word, at, sym = word[order], at[order], sym[order]
        return self._to_ids(len(words), word, at, sym, chars)

    def _to_ids(self, n: int, word: np.ndarray, at: np.ndarray, sym: np.ndarray, chars: np.ndarray) -> list[bytes]:
        plain = sym < self.n_pieces
        if plain.all():
            ids, owner = sym, word
        else:
            ids_list, owners = [], []
            for s, w, a in zip(sym.tolist(), word.tolist(), at.tolist()):
                got = [s] if s < self.n_pieces else [
                    self.byte_ids[b] for b in chr(chars[a]).encode("utf-8", "surrogatepass")]
                ids_list += got
                owners += [w] * len(got)
            ids, owner = np.array(ids_list), np.array(owners)
        flat = ids.astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(owner, minlength=n)) * 4
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def split(self, text: str) -> list[str]:
        """The stretches of a text that no piece reaches across."""
        return self.words.findall(" " + text.replace(_SPACE, " ")) if text else []

    # decoding

    def decode(self, ids: np.ndarray) -> str:
        """Text of ``ids``: control ids are skipped, the first word's space is dropped."""
        control = (ids == self.bos) | (ids == self.eos)
        runs = [r for r in np.split(ids[~control], (np.flatnonzero(control) - np.arange(control.sum()))) if len(r)]
        out = []
        for k, run in enumerate(runs):  # bytes on both sides of a control id don't make a character
            raw = b"".join(map(self.bytes_of.__getitem__, run.tolist()))
            if k == 0 and self.leads[run[0]]:
                raw = raw[1:]
            try:
                out.append(raw.decode())
            except UnicodeDecodeError:
                out.append(_lenient(raw))
        return "".join(out)


def _lenient(raw: bytes) -> str:
    """UTF-8 with every byte that is part of no character as U+FFFD."""
    out, i = [], 0
    while i < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[i:i + n].decode())
                i += n
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            i += 1
    return "".join(out)


def read_model(path: str) -> tuple[list[tuple[str, float, str]], int, int]:
    """Pieces and begin / end ids of a model file; its encoder is not used."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    kind = lambda i: ("control" if sp.is_control(i) else "unknown" if sp.is_unknown(i)
                      else "byte" if sp.is_byte(i) else "unused" if sp.is_unused(i) else "normal")
    pieces = [(sp.id_to_piece(i), sp.get_score(i), kind(i)) for i in range(sp.get_piece_size())]
    if any(k == "unused" for _, _, k in pieces):
        raise ValueError("models with unused pieces are not supported")
    return pieces, sp.bos_id(), sp.eos_id()


class Encoder:
    """Encodes batches of texts, keeping the ids of words it has seen (a bounded number)."""

    def __init__(self, vocabulary: Vocabulary, cache_words: int = CACHE_WORDS) -> None:
        self.v, self.limit, self.seen = vocabulary, cache_words, {}
        self.ends = np.array([vocabulary.bos, vocabulary.eos], dtype="<u4").tobytes()

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        out = []
        for i in range(0, len(texts), 256):
            split = [self.v.split(t or "") for t in texts[i:i + 256]]
            fresh = list(set().union(*split) - self.seen.keys())
            if len(self.seen) + len(fresh) > self.limit:
                self.seen = {}
                fresh = list(set().union(*split))
            self.seen.update(zip(fresh, self.v.encode_words(fresh)))
            out += [b"".join((self.ends[:4], *map(self.seen.__getitem__, words), self.ends[4:])) for words in split]
        return out


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids, decoded) for every row.

    ``ids`` is binary: little-endian unsigned 32-bit ids with the begin and
    end id; ``decoded`` the text that the ids decode to.  Null counts as the
    empty text (two ids); repeated rows come back as often as they came.  The
    vocabulary (of fixed size) goes to the tasks as a broadcast.
    """
    spark = docs.sparkSession
    ship_package(spark)
    model = spark.sparkContext.broadcast(read_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(*model.value)
        encode = Encoder(v)
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                b = whole.slice(i, 512)
                ids = encode(b.column(1).to_pylist())
                texts = [v.decode(np.frombuffer(x, dtype="<u4")) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                     pa.array(texts, pa.string())], names=["id", "n_tokens", "ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, n_tokens long, ids binary, decoded string")


def decode_ids(frame: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded) from little-endian 32-bit ids; null ids decode to the empty text."""
    spark = frame.sparkSession
    ship_package(spark)
    model = spark.sparkContext.broadcast(read_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(*model.value)
        for b in batches:
            texts = [v.decode(np.frombuffer(x or b"", dtype="<u4")) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["id", "decoded"])

    rows = frame.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"id {dict(frame.dtypes)[id_col]}, decoded string")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode_decode(table(spark, sf_dir, "documents"), default_model())
    return found.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
