"""Tables of distinct chunks: encode every distinct piece of text once and join the ids back by position.

A chunk is a stretch of text that no token can cross: a word with the white-space marker before it. Every
Arrow batch is cut into chunks and dictionary-encoded column-wise; only its distinct chunks are looked up
in the worker's table, those that it lacks are encoded in one go, and a take and a binary join put the
encodings of each text together in the order of its chunks. The table is cut back when it holds `limit`
chunks, and chunks of over LONGEST characters are never kept, so its memory is bounded whatever the number
of distinct words is; the result does not depend on when that happens.

A table per worker, not one shuffled table: almost every row of a corpus-wide join by chunk would be an
occurrence of a word, which is the whole corpus again, many times larger than what it saves.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from functools import lru_cache
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import keeps

#: Chunks that a worker holds at most; at the limit the first third stays, which has the frequent ones.
LIMIT = 400_000
#: Characters of the longest chunk that is kept.
LONGEST = 128
#: Chunks that are given to a tokenizer as one text, and pretokens as one sequence.
PACK, SEQUENCE = 40, 1000

# Letters, and signs other than the apostrophe and "<", of which every pattern here makes whole runs.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
SIGNS = r"!-&(-/:;=-@\[-`{-~"
#: Chunks of these characters alone are cut here; all others by the library.
SIMPLE = re.compile(f"\n?[{LETTERS}0-9{SIGNS}]+")


class Chunked:
    """The chunk table of one encoder.

    split(texts) gives the list column of the chunks of each text, encode(chunks) their values. A value of
    None marks a chunk that cannot stand alone; whole(text) then encodes the text that holds it.
    """

    def __init__(self, split: Callable[[pa.Array], pa.ListArray], encode: Callable[[list[str]], Iterable], whole: Callable[[str], object], limit: int = LIMIT):
        self.split, self.encode, self.whole, self.limit = split, encode, whole, limit
        self.table: dict = {}

    def values(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array, list]:
        """Where each text's chunks begin, the number of every chunk, and the value of every number."""
        pa.default_memory_pool().release_unused()  # of the batch before
        cut = self.split(texts)
        flat = cut.flatten().dictionary_encode()
        if len(self.table) > self.limit:
            self.table = dict(islice(self.table.items(), self.limit // 3))
        chunks = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.table.get, chunks, repeat(self)))
        missing = [i for i, value in enumerate(found) if value is self]
        for at in range(0, len(missing), 20_000):
            part = missing[at : at + 20_000]
            for i, value in zip(part, self.encode([chunks[i] for i in part])):
                found[i] = value
                if len(chunks[i]) <= LONGEST:
                    self.table[chunks[i]] = value
        offsets = cut.offsets.to_numpy()
        return offsets - offsets[0], flat.indices, found


def joined(offsets: np.ndarray, numbers: pa.Array, values: list[bytes | None]) -> pa.Array:
    """The values of each text's chunks as one binary; null where one of them is None."""
    each = pa.array(values, pa.large_binary()).take(numbers)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), each), pa.scalar(b"", each.type))


def words(texts: pa.Array) -> pa.ListArray:
    """Cut at single spaces and before line feeds; a chunk after a line feed begins with it, all but the
    first of the others had a space before them. Runs of spaces leave empty chunks."""
    return pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")


def stands_alone(chunk: str) -> bool:
    """Whether nothing beside the chunk can change how it is cut: it begins and ends in visible text."""
    core = chunk[1:] if chunk[:1] == "\n" else chunk
    return bool(core) and not core[0].isspace() and not core[-1].isspace()


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def vocabulary_size(path: str) -> int:
    """One more than the tokenizer's highest id."""
    return max(_tokenizer(path).get_vocab(with_added_tokens=True).values(), default=0) + 1


def _packed(tok, raws: list[str], glue: str, mark: int) -> list[bytes]:
    """Encode many chunks as texts of PACK chunks each, in which glue always becomes the lone id mark."""
    packs = [raws[at : at + PACK] for at in range(0, len(raws), PACK)]
    out: list[bytes] = []
    for part, done in zip(packs, tok.encode_batch_fast([glue.join(p) + glue for p in packs], add_special_tokens=False)):
        ids = np.array(done.ids, "<u4")
        ends = np.flatnonzero(ids == mark).tolist()
        if len(ends) != len(part):  # a chunk made the mark itself
            out += [np.array(tok.encode(r, add_special_tokens=False).ids, "<u4").tobytes() for r in part]
            continue
        data, at = ids.tobytes(), 0
        for end in ends:
            out.append(data[4 * at : 4 * end])
            at = end + 1
    return out


class Pretokens:
    """Ids of pretokens, kept by pretoken, from the library's model; only for pre-tokenizers that make byte-level runs.

    Pretokens go to the model as one long pretokenized sequence; the lengths of the tokens tell where each ends.
    """

    def __init__(self, tok, pattern: str, expected: list[dict], limit: int = LIMIT // 2):
        from tokenizers import Tokenizer

        spec = json.loads(tok.to_str())
        given = spec["pre_tokenizer"]
        self.limit, self.table = limit, {}
        self.parts = re.compile(pattern)
        self.fits = spec["model"]["type"] == "BPE" and not spec["model"].get("dropout") and given in expected and not any(SIMPLE.fullmatch(t["content"]) for t in spec["added_tokens"])
        if not self.fits:
            return
        self.bare = Tokenizer(tok.model)
        suffix = spec["model"].get("end_of_word_suffix") or ""
        vocab = spec["model"]["vocab"]
        self.sizes = np.zeros(max(vocab.values(), default=0) + 1, np.int64)
        for token, i in vocab.items():
            self.sizes[i] = len(token) - len(suffix) * bool(suffix and token.endswith(suffix))
        # The byte-level alphabet: visible characters of Latin-1 stand for themselves, the others follow 255.
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in set(own)]
        self.alphabet = {b: 256 + k for k, b in enumerate(rest)} | {b: b for b in own}

    def _encode(self, pretokens: list[str]) -> Iterable[bytes]:
        space = chr(self.alphabet[32])
        spelt = [p.replace(" ", space) if p.isascii() else p.encode().decode("latin-1").translate(self.alphabet) for p in pretokens]
        packs = [spelt[at : at + SEQUENCE] for at in range(0, len(spelt), SEQUENCE)]
        for part, done in zip(packs, self.bare.encode_batch_fast(packs, is_pretokenized=True, add_special_tokens=False)):
            ids = np.array(done.ids, "<u4")
            ends, want = np.cumsum(self.sizes[ids]), np.cumsum([len(p) for p in part])
            at = np.searchsorted(ends, want)
            if at[-1] >= len(ends) or (ends[at] != want).any():
                raise ValueError("a token crosses pretokens")
            data, bounds = ids.tobytes(), [0, *(4 * (at + 1)).tolist()]
            yield from (data[a:b] for a, b in zip(bounds, bounds[1:]))

    def ids(self, cut: list[list[str]]) -> list[bytes]:
        """The ids of chunks that are given as lists of their pretokens."""
        if len(self.table) > self.limit:
            self.table = dict(islice(self.table.items(), self.limit // 3))
        missing = list({p for parts in cut for p in parts if p not in self.table})
        self.table.update(zip(missing, self._encode(missing)))
        find = self.table.__getitem__
        return [find(parts[0]) if len(parts) == 1 else b"".join(map(find, parts)) for parts in cut]


@lru_cache(maxsize=4)
def byte_bpe(path: str) -> Chunked:
    """Byte-level BPE whose pattern gives a word the one space before it. Values: ids as uint32 bytes."""
    tok = _tokenizer(path)
    feed = np.array(tok.encode("\n", add_special_tokens=False).ids, "<u4")
    gap = re.compile(r"(?<=\S) (?=\S)")
    byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    runs = Pretokens(tok, f" ?(?:[{LETTERS}]+|[0-9]+|[{SIGNS}]+)", [byte_level])
    plain_text = json.loads(tok.to_str())["normalizer"] is None

    def whole(text: str) -> bytes:
        # White-space runs stay inside the pieces; the first piece has no space before it.
        out = []
        for i, piece in enumerate(gap.split(text)):
            raw = " " * (i > 0) + piece
            known = table.table.get(piece) if i else None
            out.append(np.array(tok.encode(raw, add_special_tokens=False).ids, "<u4").tobytes() if known is None else known)
        return b"".join(out)

    def by_library(raws: list[str]) -> list[bytes]:
        return _packed(tok, raws, "\n", int(feed[0])) if len(feed) == 1 else [np.array(tok.encode(r, add_special_tokens=False).ids, "<u4").tobytes() for r in raws]

    def encode(chunks: list[str]) -> list[bytes | None]:
        out: list[bytes | None] = [None] * len(chunks)
        line = feed.tobytes()
        simple = [i for i, c in enumerate(chunks) if SIMPLE.fullmatch(c)] if runs.fits and plain_text else []
        cut = [runs.parts.findall(chunks[i][1:] if chunks[i][0] == "\n" else " " + chunks[i]) for i in simple]
        for i, ids in zip(simple, runs.ids(cut) if simple else ()):
            out[i] = line + ids if chunks[i][0] == "\n" else ids
        rest = [i for i, c in enumerate(chunks) if out[i] is None and stands_alone(c)]
        for i, ids in zip(rest, by_library([chunks[i][1:] if chunks[i][0] == "\n" else " " + chunks[i] for i in rest])):
            out[i] = line + ids if chunks[i][0] == "\n" else ids
        return out

    def split(texts: pa.Array) -> pa.ListArray:
        # The first word has no space before it: cut as if it followed a line feed, whose id goes again.
        return pc.split_pattern(pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), ""), " ")

    table = Chunked(split, encode, whole)
    table.skip = 4 * len(feed)  # type: ignore[attr-defined]
    return table


@lru_cache(maxsize=4)
def word_bpe(path: str, limit: int = LIMIT) -> Chunked:
    """BPE over words with white space dropped. Values: ids as uint32 bytes. limit: chunks that its table holds at most."""
    tok = _tokenizer(path)
    glue = "<|startoftext|>"
    mark = tok.token_to_id(glue)
    # The normalizer and pre-tokenizer of the public CLIP vocabulary.
    normal = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
    pattern = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
    runs = Pretokens(tok, f"[{LETTERS}]+|[0-9]|[{SIGNS}]+", [{"type": "Sequence", "pretokenizers": [pattern, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}], limit // 2)
    lowers = json.loads(tok.to_str())["normalizer"] == normal

    def whole(text: str) -> bytes:
        return np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(chunks: list[str]) -> list[bytes]:
        out: list[bytes | None] = [b"" if not c else None for c in chunks]
        simple = [i for i, c in enumerate(chunks) if SIMPLE.fullmatch(c)] if runs.fits and lowers else []
        for i, ids in zip(simple, runs.ids([runs.parts.findall(chunks[i].lower()) for i in simple]) if simple else ()):
            out[i] = ids
        rest = [i for i, ids in enumerate(out) if ids is None]
        raws = [chunks[i] for i in rest]
        for i, ids in zip(rest, [whole(c) for c in raws] if mark is None else _packed(tok, raws, f" {glue} ", mark)):
            out[i] = ids
        return out

    return Chunked(pc.ascii_split_whitespace, encode, whole, limit)


def ids_of(table: Chunked, texts: pa.Array) -> pa.Array:
    """The ids of each text as little-endian unsigned 32-bit bytes (a large_binary column)."""
    skip = getattr(table, "skip", 0)
    offsets, numbers, values = table.values(texts)
    if skip:  # of the first chunk of each text
        numbers, first = numbers.to_numpy().copy(), offsets[:-1]
        known, at = np.unique(numbers[first], return_inverse=True)
        numbers[first] = len(values) + at
        values = values + [values[k] and values[k][skip:] for k in known.tolist()]
        numbers = pa.array(numbers)
    ids = joined(offsets, numbers, values)
    empty = pc.equal(pc.binary_length(texts), 0)
    if ids.null_count or pc.any(empty).as_py():
        rest = pc.or_(pc.is_null(ids), empty)
        put = [b"" if not t else table.whole(t) for t in texts.filter(rest).to_pylist()]
        ids = pc.replace_with_mask(ids, rest, pa.array(put, ids.type))
    return ids


@lru_cache(maxsize=2)
def _pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def pieces(path: str) -> Chunked:
    """SentencePiece ids and decoded text of marked words. Values: (ids bytes, decoded bytes).

    Holds for models whose pieces have the white-space marker only at their start and no line feed; for
    others every text is encoded whole.
    """
    sp = _pieces(path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    plain = not any("▁" in n.lstrip("▁") or "\n" in n for n in names) and sp.encode("a  b") != sp.encode("a b")

    def whole(text: str) -> tuple[bytes, bytes]:
        ids = sp.encode(text)
        return np.array(ids, "<u4").tobytes(), sp.decode(ids).encode()

    def encode(chunks: list[str]) -> list:
        out: list = [None] * len(chunks)
        if not plain:
            return out
        good = [i for i, c in enumerate(chunks) if c and not c.endswith("▁") and c != "\n"]
        # "▁\n…" never merges across the feed: the first id is the lone marker, and goes.
        ids = sp.encode([chunks[i] for i in good], num_threads=1)
        ids = [x[1:] if chunks[i][0] == "\n" else x for i, x in zip(good, ids)]
        for i, x, text in zip(good, ids, sp.decode(ids, num_threads=1)):
            out[i] = (np.array(x, "<u4").tobytes(), (text if chunks[i][0] == "\n" else " " + text).encode())
        return out

    table = Chunked(words, encode, whole)
    table.plain = plain  # type: ignore[attr-defined]
    return table


def _forget() -> None:
    """Let the tables go, and the tokenizers, which they refer to."""
    for made in (byte_bpe, word_bpe, pieces, _tokenizer, _pieces):
        made.cache_clear()


keeps("chunks", _forget)
