"""SentencePiece BPE encoding and decoding in vectorised merge rounds."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mergewell.llm.common import chunks, text_bytes

SPACE = "▁"
#: Texts on which a model must agree with the library before it is used: normalisation that this module does not do would show here.
PROBES = ("", " ", "a", "  two  spaces ", "line\none\ttab\rend ", "\uff21\uff22 \ufb01n \u2460 e\u0301 \u00e9", "\u3000wide\u00a0hard\u200bzero", "<s></s><unk> 0x41 \u2581\u2581x", "AbC dEf", "\U0001f600\u4e2d\u6587\x00\x01\ufffd", "aaaaaaaaaaaa", "don't stop-it, 3.14!")
#: Symbols that the rounds merge at a time, or those of one longer word.
BLOCK = 1 << 20
#: Distinct words that a task remembers before it starts anew.
REMEMBERED = 250_000


class PieceModel:
    """The merge rules, pieces and byte fallback of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = library.get_piece_size()
        self.pieces = [library.id_to_piece(i) for i in range(n)]
        self.special = {i for i in range(n) if library.is_control(i) or library.is_unknown(i) or library.is_unused(i)}
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(n) if library.is_byte(i)}
        self.end, self.unknown = library.eos_id(), library.unk_id()
        plain = [i for i in range(n) if i not in self.special and not library.is_byte(i)]
        self.ids = {self.pieces[i]: i for i in plain}
        ranked = sorted(plain, key=lambda i: -library.get_score(i))
        rank = {}
        for i in ranked:  # equal scores share a rank: the leftmost pair goes first
            score = library.get_score(i)
            rank[i] = rank[last] if rank and score == library.get_score(last) else len(rank)  # noqa: F821
            last = i  # noqa: F841
        self._symbols(plain, rank)
        self._decoder()
        for probe in PROBES:
            if self.encode(probe) != library.encode(probe, add_eos=True):
                raise ValueError(f"the model at {path} treats {probe!r} in a way that is not supported (its normaliser, kind or flags)")

    def _symbols(self, plain: list[int], rank: dict[int, int]) -> None:
        """Symbols are pieces and the characters that only occur inside pieces; merges lists (left, right) -> symbol."""
        strings = [self.pieces[i] for i in plain]
        known = set(strings)
        strings += sorted({c for s in strings for c in s} - known)
        number = {s: k for k, s in enumerate(strings)}
        self.symbol_id = np.array([self.ids.get(s, -1) for s in strings], np.int32)
        self.symbol_text = strings
        self.char_symbol = {s: k for s, k in number.items() if len(s) == 1}
        merges = {}
        self.joined: set[str] = set()
        for i in plain:
            s = self.pieces[i]
            for cut in range(1, len(s)):
                self.joined.add(s[cut - 1 : cut + 1])
                a, b = number.get(s[:cut]), number.get(s[cut:])
                if a is not None and b is not None:
                    merges[a * len(strings) + b] = (rank[i], number[s])
        keys = np.array(sorted(merges), np.int64)
        self.pair_keys = np.append(keys, np.iinfo(np.int64).max)
        self.pair_rank = np.append(np.array([merges[k][0] for k in keys], np.int64), np.iinfo(np.int32).max)
        self.pair_symbol = np.append(np.array([merges[k][1] for k in keys], np.int64), -1)
        # after a quiet merge no pair with the new symbol ranks as low as the merge itself: all its places may go at once
        lowest = np.full(len(strings), np.iinfo(np.int64).max)
        np.minimum.at(lowest, self.pair_keys[:-1] // len(strings), self.pair_rank[:-1])
        np.minimum.at(lowest, self.pair_keys[:-1] % len(strings), self.pair_rank[:-1])
        quiet = lowest[self.pair_symbol[:-1]] > self.pair_rank[:-1]
        loud = np.unique(self.pair_rank[:-1][~quiet])
        self.quiet_rank = np.ones(int(self.pair_rank[:-1].max(initial=0)) + 2, bool)
        self.quiet_rank[loud] = False
        self.joined_keys = np.unique(np.array([self.char_symbol[p[0]] * len(strings) + self.char_symbol[p[1]] for p in self.joined], np.int64))
        self.splits_at_space = not any(p[0] != SPACE and p[1] == SPACE for p in self.joined)

    def _decoder(self) -> None:
        content = []
        for i, piece in enumerate(self.pieces):
            if i in self.special:
                content.append(" ⁇ ".encode() if i == self.unknown else b"")
            else:
                content.append(piece.replace(SPACE, " ").encode())
        for byte, i in self.byte_ids.items():
            content[i] = bytes([byte])
        self.is_byte = np.zeros(len(content), bool)
        self.is_byte[list(self.byte_ids.values())] = True
        self.piece_length = np.array([len(c) for c in content], np.int64)
        self.piece_start = np.concatenate([[0], self.piece_length.cumsum()[:-1]])
        self.piece_bytes = np.frombuffer(b"".join(content), np.uint8)
        self.leading_space = np.array([self.pieces[i][:1] == SPACE if i not in self.special else False for i in range(len(content))])

    # -- encoding

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = np.where((left >= 0) & (right >= 0), left * len(self.symbol_text) + right, -1)
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, at, len(self.pair_keys) - 1)

    def _rounds(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merges all words at once; returns symbols, words and the first character of each symbol.

        In each round every word merges its pair of smallest rank: the leftmost of equal ones, or, where
        no pair with the merged symbol can rank as low, all of them from the left that do not overlap,
        which are the very next merges anyway. Merged positions are compacted away, and words without a
        pair leave the arrays. So a long word takes as many rounds as it has kinds of merges, not merges.
        """
        origin = np.arange(len(symbols))
        finished: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(symbols) > 1:
            at = np.full(len(symbols), len(self.pair_keys) - 1)
            same = owner[1:] == owner[:-1]
            at[:-1][same] = self._rank(symbols[:-1][same], symbols[1:][same])
            ranks = self.pair_rank[at]
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lengths = np.diff(np.r_[starts, len(symbols)])
            least = np.repeat(np.minimum.reduceat(ranks, starts), lengths)
            alive = least < self.pair_rank[-1]
            if not alive.any():
                break
            best = np.flatnonzero(alive & (ranks == least))
            # within a run of neighbouring places every second one merges, from its left
            begins = np.flatnonzero(np.r_[True, np.diff(best) > 1])
            place = np.arange(len(best)) - np.repeat(begins, np.diff(np.r_[begins, len(best)]))
            first = np.r_[True, owner[best[1:]] != owner[best[:-1]]]
            merged = best[first | ((place % 2 == 0) & self.quiet_rank[ranks[best]])]
            symbols[merged] = self.pair_symbol[at[merged]]
            keep = np.ones(len(symbols), bool)
            keep[merged + 1] = False
            if not alive.all():
                finished.append((symbols[~alive], owner[~alive], origin[~alive]))
                keep &= alive
            symbols, owner, origin = symbols[keep], owner[keep], origin[keep]
        finished.append((symbols, owner, origin))
        symbols, owner, origin = (np.concatenate(x) for x in zip(*finished))
        order = np.argsort(origin, kind="stable")
        return symbols[order], owner[order], origin[order]

    def _spelled(self, symbol: int, char: str) -> list[int]:
        """The id of a symbol, or the byte ids of a character that is no piece."""
        if symbol >= 0 and self.symbol_id[symbol] >= 0:
            return [int(self.symbol_id[symbol])]
        return [self.byte_ids.get(b, self.unknown) for b in char.encode()] if self.byte_ids else [self.unknown]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, flat, and how many each has; spaces in them are already written as the space mark.

        Words are cut where no piece joins two neighbouring characters, for no merge crosses such a place.
        """
        flat = "".join(words)
        symbols = np.fromiter(map(self.char_symbol.get, flat, repeat(-1)), np.int64, len(flat))
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        apart = np.ones(len(flat), bool)
        apart[1:] = owner[1:] != owner[:-1]
        known = (symbols[1:] >= 0) & (symbols[:-1] >= 0)
        joins = np.zeros(len(known), bool)
        joins[known] = np.isin(symbols[:-1][known] * len(self.symbol_text) + symbols[1:][known], self.joined_keys)
        apart[1:] |= ~joins
        merged, _, origin = self._rounds(symbols, apart.cumsum())
        owner = owner[origin]
        ids = np.where(merged >= 0, self.symbol_id[merged], -1).astype(np.int64)
        special = np.flatnonzero(ids < 0)
        if not len(special):
            return ids.astype(np.int32), np.bincount(owner, minlength=len(words))
        spelled = [self._spelled(-1, flat[origin[i]]) for i in special]
        lengths = np.ones(len(ids), np.int64)
        lengths[special] = [len(x) for x in spelled]
        out = np.repeat(ids, lengths)
        begin = lengths.cumsum() - lengths
        for i, found in zip(special, spelled):
            out[begin[i] : begin[i] + len(found)] = found
        return out.astype(np.int32), np.bincount(owner, weights=lengths, minlength=len(words)).astype(np.int64)

    def words(self, text: str) -> list[str]:
        """A text's words, each with the space marks before it; no merge crosses their borders."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        return _WORDS.findall(marked) if self.splits_at_space else [marked]

    def encode(self, text: str) -> list[int]:
        """As the library encodes text, with the end id."""
        words = self.words(text)
        return (self.encode_words(words)[0].tolist() if words else []) + [self.end]

    # -- decoding

    def decode_flat(self, ids: np.ndarray) -> bytes:
        """The bytes of the pieces, one after another."""
        lengths = self.piece_length[ids]
        ends = lengths.cumsum()
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.piece_start[ids] - (ends - lengths), lengths)
        return self.piece_bytes[at].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """As the library decodes ids: the first piece loses its leading space, bytes that are no UTF-8 become replacement characters."""
        ids = np.asarray(ids, np.int64)
        shown = ids[self.piece_length[ids] > 0] if len(ids) else ids
        raw = self.decode_flat(ids)
        if len(shown) and self.leading_space[shown[0]]:
            raw = raw[1:]
        return "".join("�" if 0xDC80 <= ord(c) <= 0xDCFF else c for c in raw.decode("utf-8", "surrogateescape")) if not _is_utf8(raw) else raw.decode()


_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_MODELS: dict[str, PieceModel] = {}


def _is_utf8(raw: bytes) -> bool:
    try:
        raw.decode()
        return True
    except UnicodeDecodeError:
        return False


def model_at(path: str) -> PieceModel:
    """The model, read once a process."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


class Encoder:
    """Encodes batches of texts; each distinct word is merged once and then remembered."""

    def __init__(self, model: PieceModel):
        self.model = model
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.texts: list[str] = []
        self.flat = np.zeros(0, np.int32)
        self.start = np.zeros(1, np.int64)

    def _learn(self, words: list[str]) -> None:
        """Merges the words in blocks of about BLOCK symbols, so that the arrays of a round stay small."""
        blocks, size = [[]], 0
        for word in words:
            if size and size + len(word) > BLOCK:
                blocks.append([])
                size = 0
            blocks[-1].append(word)
            size += len(word)
        made = [self.model.encode_words(block) for block in blocks]
        ids, lengths = (np.concatenate(x) for x in zip(*made))
        ends = lengths.cumsum()
        shown = list(map(str, ids.tolist()))
        known = len(self.texts)
        self.texts += [" ".join(shown[a:b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
        self.number.update(zip(words, range(known, known + len(words))))
        self.flat = np.concatenate([self.flat, ids])
        self.start = np.concatenate([self.start, self.start[-1] + ends])

    def encode(self, texts: list[bytes]) -> list[tuple[np.ndarray, str]]:
        """For each text its ids with the end id, and the same as decimal text."""
        if len(self.number) > REMEMBERED:
            self._clear()
        words = [self.model.words(t.decode("utf-8", "replace")) for t in texts]
        new = list(dict.fromkeys(w for ws in words for w in ws if w not in self.number))
        if new:
            self._learn(new)
        out = []
        for ws in words:
            which = [self.number[w] for w in ws]
            at = np.array(which, np.int64)
            lengths = self.start[at + 1] - self.start[at]
            ends = lengths.cumsum()
            total = int(ends[-1]) if len(ends) else 0
            ids = self.flat[np.arange(total) + np.repeat(self.start[at] - (ends - lengths), lengths)]
            text = " ".join([self.texts[k] for k in which] + [str(self.model.end)])
            out.append((np.append(ids, np.int32(self.model.end)), text))
        return out


def tokenise(documents: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) for every document: the whole text encoded with the end id, and decoded again.

    Null texts count as empty: the end id alone; repeated rows are encoded as often as they come, and an
    empty table gives an empty result. Memory holds a few megabytes of text at a time, or one longer
    text. The model file must be readable at path on every executor; a model that normalises texts or is
    of another kind is refused. Ids must be whole numbers.
    """
    from hashlib import sha256

    fields = [pa.field("doc_id", pa.int64()), pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())]
    fields += [pa.field("ids", pa.list_(pa.int32()))] * with_ids
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_at(path)
        encoder = Encoder(model)
        for batch in batches:
            done = 0
            for part in chunks(text_bytes(batch.column(1)), 1 << 20):
                found = encoder.encode(part)
                columns = [
                    batch.column(0).slice(done, len(part)).cast(pa.int64()), pa.array([len(ids) for ids, _ in found], pa.int64()),
                    pa.array([sha256(s.encode()).hexdigest() for _, s in found]), pa.array([sha256(model.decode(ids).encode()).hexdigest() for ids, _ in found]),
                ]
                if with_ids:
                    offsets = np.concatenate([[0], np.cumsum([len(ids) for ids, _ in found])]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([ids for ids, _ in found]), pa.int32())))
                done += len(part)
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = documents.select(documents[doc_id].alias("doc_id"), documents[text].alias("text"))
    shape = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return rows.mapInArrow(run, shape)
