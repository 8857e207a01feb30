"""Token ids of whole texts with a public tokenizer file (operators 3, 10 and 12).

Both tokenizers of the contracts treat a run of non-space characters the same
way wherever it stands, so a text is cut at white space, each distinct run is
tokenised once by the ``tokenizers`` library, and its ids are kept as packed
little-endian unsigned 32-bit bytes in a per-worker cache of bounded size.  A
text's ids are then one ``bytes.join``.  Runs of plain Latin characters go
straight to the library's BPE model; every other run goes through the whole
library pipeline.  ``batch`` does the same for many texts at once: Arrow cuts
them and numbers their distinct runs, so a run is looked up once a batch; a run
that ends in marks is looked up without them too, and all ids lie in flat arrays.

The caches have two generations: what is used moves to the young one, and when that
is full the old one goes, so frequent runs stay.  An encoder compares itself with the library on
``PROBES`` when it is built, and leaves every text to the library where they differ (another kind of
tokenizer file).

Control strings inside a text (``<|endoftext|>``) are ordinary text.  Null
texts are empty and have no ids.
"""

from __future__ import annotations

import os
import re
from array import array
from codecs import charmap_decode

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_ENTRIES = 450_000  # of one generation
WORD_ENTRIES = 200_000  # the same for runs of a word tokenizer: a pipeline's later stages share the worker's memory
PIECE_ENTRIES = 300_000
FIRST_ENTRIES = 100_000  # of what a byte-level file is asked for text by text, and of its pieces
CALL_RUNS = 500  # unknown runs given to the library at once
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_NONE, _NO_SIZE, _NO_RUNS = np.zeros(0, "<u4"), np.zeros(0, np.int64), pa.array([], pa.large_string())
_NO_KEYS, _NO_PLACE = np.zeros(0, np.uint64), np.zeros(0, np.int32)
_BYTE_KEYS = np.random.default_rng(11).integers(0, 1 << 64, 256, np.uint64)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

# Runs that carry their white space the way the byte-level pre-tokenizer does.
_BYTE_RUNS = re.compile(r" ?\S+|\s+(?!\S)|\s+")
# \x1c-\x1f are white space for Python only: texts that hold them are not cut.
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
PROBES = ["Plain words, and more words.\nA line\n\n  two  spaces\tand a tab \n", "don't WE'RE I'll 'twas it's",
          "x=1234.5; y[0]!=7 (a) <|b|> <|", "Été coöperate straße ИМЯ 中文 ﬁ e\u0301 é \u3000wide space",
          "<|endoftext|> x<|endoftext|>", " lead", "trail ", "\n", "😀 a😀b", "ǅ İi ΑΣ Σ", "odd\x1cspace"]


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    for the code points from 256 on, in byte order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class TextEncoder:
    """Ids of texts by one tokenizer file; ``words`` says which of the two kinds it is:
    True for the lower-casing word tokenizer, False for the byte-level one."""

    def __init__(self, path: str, words: bool):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        model, letters = self.tokenizer.model, byte_letters()
        to_letters = [letters[b] for b in range(256)]
        self.letters = "".join(to_letters)
        if words:
            plain = re.compile(f"[{_LATIN}0-9.,;:!?%&$#*()\"+@/=-]+")
            pieces = re.compile(f"[{_LATIN}]+|[0-9]|[^{_LATIN}0-9]+").findall
        else:
            plain = re.compile(f"(?: ?[{_LATIN}0-9.,;:!?%&$#*()\"+@/=-]+|\n)")
            pieces = re.compile(f" ?[{_LATIN}]+| ?[0-9]+| ?[^{_LATIN}0-9 \n]+|\n").findall

        class Cache(dict):
            def __init__(self, ids, most: int, before: str = ""):
                self.ids, self.most, self.before, self.old = ids, most, before, {}

            def __missing__(self, key: str) -> bytes:
                packed = self.old.pop(key, None)
                if packed is None:
                    packed = self.ids(self.before + key)
                if len(key) <= 64:
                    if len(self) >= self.most:
                        self.old = dict(self)
                        self.clear()
                    self[key] = packed
                return packed

        space, tokenize = to_letters[32], model.tokenize

        def piece_ids(piece: str) -> bytes:
            if not piece.isascii() or "\n" in piece:
                piece = "".join([to_letters[b] for b in piece.encode()])
            elif piece[0] == " ":
                piece = space + piece[1:]
            return array("I", [t.id for t in tokenize(piece)]).tobytes()

        by_piece = Cache(piece_ids, PIECE_ENTRIES if words else FIRST_ENTRIES)

        def run_ids(run: str) -> bytes:
            word = run.rstrip(".,")  # most runs are one ASCII word and a mark
            if word and word.isascii() and (word[1:] if word[0] == " " else word).isalpha():
                ids = by_piece[word.lower() if words else word]
                return ids + by_piece[run[len(word):]] if len(word) < len(run) else ids
            if not plain.fullmatch(run):
                return self._library(run)
            return b"".join([by_piece[p] for p in pieces(run.lower() if words else run)])

        self.words = words
        self.cache = Cache(run_ids, WORD_ENTRIES if words else FIRST_ENTRIES)
        self.spaced = Cache(run_ids, RUN_ENTRIES, " ")  # by the run without its space
        self.newline = b"" if words else run_ids("\n")
        self.young, self.old = _Runs(), _Runs()  # of chunks, see ``batch``
        vocab = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocab.values()) + 1, bool)  # tokens that begin with a space
        self.begins[[i for token, i in vocab.items() if token.startswith(space)]] = True
        self.begins_line = np.zeros(len(self.begins), bool)
        self.begins_line[np.frombuffer(self.newline, "<u4")] = True
        self.whole = False
        alone = [self._library(p) for p in PROBES]
        self.whole = (any(self.packed(p) != ids for p, ids in zip(PROBES, alone))
                      or self.batch(PROBES)[0].tobytes() != b"".join(alone))

    def _library(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def packed(self, text: str | None) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.whole:
            return self._library(text)
        if not self.words and _plainly_spaced(text):
            first, spaced, newline, out = self.cache.__getitem__, self.spaced.__getitem__, self.newline, []
            for line in text.split("\n"):
                runs = iter(line.split(" "))
                out.append(first(next(runs)))
                out.extend(map(spaced, runs))
                out.append(newline)
            out.pop()
            return b"".join(out)
        if _ODD_SPACE.search(text):
            return self._library(text)
        return b"".join(map(self.cache.__getitem__, text.split() if self.words else _BYTE_RUNS.findall(text)))

    def batch(self, texts: list[str | None], space: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts`` one after the other, and how many each text has; with ``space``, of each text
        after a space.

        Chunks between spaces are runs that follow a space; a leading newline or tab (no plainly spaced text
        has tabs) marks a run after a newline or at a text's start.  A text cut in another way is one chunk,
        named by a vertical tab and its place."""
        cut, odd, first = [], {"\t": b""}, "" if space else "\t"
        for i, text in enumerate(texts):
            if (text and (self.words or self.whole or not _plainly_spaced(text))) or (space and not text):
                cut.append(f"\v{i}")
                odd[cut[-1]] = self.packed(" " + (text or "") if space else text)
            else:
                cut.append(first + (text or "").replace("\n", " \n"))
        chunks = pc.split_pattern(pa.array(cut, pa.large_string()), " ")
        coded = chunks.values.dictionary_encode()
        ids, starts, sizes = self._chunk_ids(coded.dictionary, odd)
        chunk = coded.indices.to_numpy()
        lengths = sizes[chunk]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return stretches(ids, starts[chunk], lengths), np.diff(ends[chunks.offsets.to_numpy()])

    def _chunk_ids(self, chunks: pa.Array, odd: dict[str, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where in them those of each distinct chunk start and how many they are; chunks not known go
        to the library together."""
        young, place = self.young, self._known(chunks)
        missed = np.flatnonzero(place < 0)
        unknown = chunks.take(pa.array(missed))
        kind, texts = _first_bytes(unknown), _strings(unknown)
        parts, found = [], []
        for mine, ids_of in ((kind > 32, self._spaced_ids), (kind == 10, self._line_ids),
                             (kind < 10, lambda some: _flat([self.cache[r[1:]] if len(r) > 1 else b"" for r in some])),
                             (kind == 11, lambda some: _flat([odd[r] for r in some]))):
            parts.append(missed[mine])
            found.append(ids_of([texts[i] for i in np.flatnonzero(mine).tolist()]))
        kept = np.concatenate([np.flatnonzero(place >= len(young)), *parts[:-1]])  # odd texts are not
        held, of_held = self._held(place)
        order = np.concatenate([*held, *parts])
        known = _Runs(*map(np.concatenate, zip(*of_held, *found)))
        place = np.empty(len(chunks), np.int64)
        place[order] = np.arange(len(order))
        kept = kept[pc.binary_length(chunks).to_numpy()[kept] <= 64]
        if len(young) + len(kept) > RUN_ENTRIES:
            self.old, self.young = young, _Runs()
        kept = kept[:RUN_ENTRIES]
        self.young = self.young.joined(chunks.take(pa.array(kept)), *known.taken(place[kept]))
        return known.ids, known.starts[place], known.sizes[place]

    def _held(self, place: np.ndarray) -> tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
        """Which of ``place`` are young and which old ones, and the ids and sizes of both."""
        young, old = np.flatnonzero((place >= 0) & (place < len(self.young))), np.flatnonzero(place >= len(self.young))
        return [young, old], [self.young.taken(place[young]), self.old.taken(place[old] - len(self.young))]

    def _known(self, runs: pa.Array) -> np.ndarray:
        """Each run's place among the young and then the old ones, -1 where it is neither."""
        keys = _keys(runs)
        place = self.young.places(runs, keys)
        missed = np.flatnonzero(place < 0)
        old = self.old.places(runs.take(pa.array(missed)), keys[missed])
        place[missed] = np.where(old < 0, -1, old + len(self.young))
        return place

    def _spaced_ids(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each run after a space, one after the other, and how many each has."""
        return self._bare_ids(runs, " ")

    def _line_ids(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for runs that begin with a newline."""
        return self._bare_ids(runs, "")

    def _bare_ids(self, runs: list[str], before: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each run after ``before``.  Marks after a letter or digit are a piece of their own, so a run that
        ends in such marks has the ids of the run without them, which may be known, and those of the marks."""
        if not runs:
            return _NONE, _NO_SIZE
        whole = pa.array(runs, pa.large_string())
        bare = pc.utf8_rtrim(whole, MARKS)
        cut = pc.and_(pc.less(pc.binary_length(bare), pc.binary_length(whole)),
                      pc.match_substring_regex(bare, f"[{_LATIN}0-9]$"))
        bare = pc.if_else(cut, bare, whole).dictionary_encode()
        marked, stems = np.flatnonzero(cut), bare.indices.to_numpy()
        lengths = pc.utf8_length(bare.dictionary).to_numpy()[stems[marked]]
        marks = pa.array([runs[i][n:] for i, n in zip(marked.tolist(), lengths.tolist())],
                         pa.large_string()).dictionary_encode()
        place = self._known(bare.dictionary)
        missed = place < 0
        latin = pc.match_substring_regex(bare.dictionary, f"^\n?[{_LATIN}]+$").to_numpy(zero_copy_only=False)
        words, others = np.flatnonzero(missed & latin), np.flatnonzero(missed & ~latin)
        found = [self._word_ids(_strings(bare.dictionary.take(pa.array(words))), before),
                 self._joined_ids(_strings(bare.dictionary.take(pa.array(others))), before),
                 _flat([self.cache[m] for m in _strings(marks.dictionary)])]
        held, of_held = self._held(place)
        order = np.concatenate([*held, words, others])
        place[order] = np.arange(len(order))
        parts = np.insert(place[stems], marked + 1, len(order) + marks.indices.to_numpy())
        ids, sizes = _Runs(*map(np.concatenate, zip(*of_held, *found))).taken(parts)
        many = np.ones(len(runs), np.int64)
        many[marked] = 2
        return ids, np.diff(np.cumsum(sizes)[np.cumsum(many) - 1], prepend=0)

    def _word_ids(self, runs: list[str], before: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each run of Latin letters after ``before``: one piece for the library's BPE model, after the
        newline's own."""
        if not runs:
            return _NONE, _NO_SIZE
        text = before + ("\n" + before).join(runs) if before else "".join(runs)[1:]
        tokenize, ids, sizes = self.tokenizer.model.tokenize, [], []
        for piece in charmap_decode(text.encode(), "strict", self.letters)[0].split(self.letters[10]):
            found = [t.id for t in tokenize(piece)]
            ids += found
            sizes.append(len(found))
        ids, sizes = np.array(ids, "<u4"), np.array(sizes, np.int64)
        if before:
            return ids, sizes
        newline = np.frombuffer(self.newline, "<u4")
        return np.insert(ids, np.repeat(np.cumsum(sizes) - sizes, len(newline)), np.tile(newline, len(runs))), sizes + len(newline)

    def _joined_ids(self, runs: list[str], before: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of any runs after ``before``: one call for many, cut where a token begins with the space or is
        the newline."""
        found, sizes = [_NONE], [_NO_SIZE]
        begins = self.begins if before else self.begins_line
        for lo in range(0, len(runs), CALL_RUNS):
            some = runs[lo:lo + CALL_RUNS]
            text = before + before.join(some)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            starts = np.flatnonzero(begins[ids])
            if len(starts) == len(some):
                found.append(ids)
                sizes.append(np.diff(starts, append=len(ids)))
            else:
                ids, counts = _flat([self._library(before + r) for r in some])
                found.append(ids)
                sizes.append(counts)
        return np.concatenate(found), np.concatenate(sizes)


def _strings(runs: pa.Array) -> list[str]:
    return runs.to_numpy(zero_copy_only=False).tolist()


def _first_bytes(runs: pa.Array) -> np.ndarray:
    """The first byte of each run, none of which is empty."""
    if not len(runs):
        return np.zeros(0, np.uint8)
    _, starts, text = runs.buffers()
    return np.frombuffer(text, np.uint8)[np.frombuffer(starts, np.int64)[runs.offset:runs.offset + len(runs)]]


def _keys(runs: pa.Array) -> np.ndarray:
    """A 64-bit hash of each run: the sum of its bytes' random numbers, each times a power by its place."""
    if not len(runs):
        return _NO_KEYS
    _, offsets, text = runs.buffers()
    ends = np.frombuffer(offsets, np.int64)[runs.offset:runs.offset + len(runs) + 1]
    raw, ends = np.frombuffer(text or b"", np.uint8)[ends[0]:ends[-1]], ends - ends[0]
    sizes = np.diff(ends)
    powers = np.multiply.accumulate(np.full(int(sizes.max(initial=0)) + 1, _FACTOR))
    summed = _BYTE_KEYS[raw]
    summed *= powers[np.arange(len(raw)) - np.repeat(ends[:-1], sizes)]
    np.add.accumulate(summed, out=summed)
    return np.diff(np.concatenate([np.zeros(1, np.uint64), summed])[ends])


class _Runs:
    """Ids of distinct runs: ``sizes`` of ``ids`` from ``starts`` on.  A run is found by its hash, in ``keys`` in order, and
    then compared with the run ``at`` that place; arrays take a tenth of the memory of a dict."""

    def __init__(self, ids: np.ndarray = _NONE, sizes: np.ndarray = _NO_SIZE, runs: pa.Array = _NO_RUNS,
                 keys: np.ndarray = _NO_KEYS, at: np.ndarray = _NO_PLACE):
        self.ids, self.sizes, self.starts = ids, sizes, np.cumsum(sizes) - sizes
        self.runs, self.keys, self.at = runs, keys, at

    def __len__(self) -> int:
        return len(self.sizes)

    def places(self, runs: pa.Array, keys: np.ndarray) -> np.ndarray:
        """The place of each of ``runs`` here, -1 where there is none."""
        place = np.full(len(runs), -1)
        if len(self):
            near = np.minimum(np.searchsorted(self.keys, keys), len(self) - 1)
            same = np.flatnonzero(self.keys[near] == keys)
            at = self.at[near[same]]
            equal = pc.equal(runs.take(pa.array(same)), self.runs.take(pa.array(at))).to_numpy(zero_copy_only=False)
            place[same[equal]] = at[equal]
        return place

    def joined(self, runs: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> _Runs:
        keys = _keys(runs)
        order = np.argsort(keys, kind="stable")
        before = np.searchsorted(self.keys, keys[order], "right")
        return _Runs(np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes]), pa.concat_arrays([self.runs, runs]),
                     np.insert(self.keys, before, keys[order]), np.insert(self.at, before, (len(self) + order).astype(np.int32)))

    def taken(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[places]
        return stretches(self.ids, self.starts[places], sizes), sizes


def stretches(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ``sizes`` of ``ids`` from each of ``starts`` on, one after the other."""
    ends = np.cumsum(sizes)
    place = np.int32 if len(ends) and max(len(ids), int(ends[-1])) < 1 << 31 else np.int64
    at = np.repeat((starts - (ends - sizes)).astype(place), sizes)
    at += np.arange(len(at), dtype=place)
    return ids[at]


def _flat(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(packed), "<u4"), np.fromiter(map(len, packed), np.int64, len(packed)) // 4


def _plainly_spaced(text: str) -> bool:
    """Whether all white space is one space or one newline between two other characters (the space is the only
    white space that counts as printable)."""
    return not (text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text
                or "\n " in text) and text.replace("\n", "").isprintable()


_ENCODERS: dict[tuple[str, bool], TextEncoder] = {}


def encoder(path: str, words: bool) -> TextEncoder:
    """One encoder per worker process and tokenizer file."""
    key = (path, words)
    if key not in _ENCODERS:
        _ENCODERS[key] = TextEncoder(path, words)
    return _ENCODERS[key]
