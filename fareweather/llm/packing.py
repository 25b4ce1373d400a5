"""Best-fit packing: documents as token ids, cut into pieces and packed into sequences.

Tokenising and packing are separate: only ids' lengths and checksums reach the packer.
A packing task holds a bounded number of open bins, found by a bitset keyed by free
space: more than it has pieces, unless one row repeats that often.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, giving_back, once, table, text_or_empty
from .words import Words, blocks

CAPACITY = 2048
#: Pieces of a packing task, about; up to half as many again where there are few tasks.
TASK_PIECES = 100_000
#: Open bins of a packing task: as many as it may have pieces, so that none closes before the
#: short pieces have come.
OPEN_BINS = 2 * TASK_PIECES
#: The id that ends a document.
END_ID = 0
#: Distinct parts of words of each kind whose ids a worker remembers, about; those of the last two blocks come on top.
REMEMBERED = 100_000
#: Characters of a block of texts, about, whose distinct words are encoded once.
BLOCK_CHARS = 5_000_000
#: Characters of texts of a block, about, whose ids are in memory at a time.
GATHERED_CHARS = 500_000
VOCABULARY = "word_bpe_49k.json"

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Recent:
    """What was met of late by key. When it is full it is set aside, and what is met again is taken back from there."""

    def __init__(self, most: int):
        self.most = most
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def of(self, keys) -> dict[bytes, bytes]:
        """All that is known of these keys, and of others."""
        if len(self.known) > self.most // 2:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        if before:
            known.update((k, before[k]) for k in keys if k in before and k not in known)
        return known


def _classes() -> np.ndarray:
    """Per byte of a plain word: what makes up parts of words. Bytes that words of other kinds have are OTHER."""
    of = np.full(256, OTHER, np.uint8)
    of[0x20] = BETWEEN
    of[0x21:0x7F] = MARK
    of[ord("'")] = OTHER  # may begin a part with letters
    of[ord("0"):ord("9") + 1] = DIGIT
    for first, last in ((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xBF), (0xC3, 0xC9), (0xD0, 0xD1)):
        of[first:last + 1] = LETTER
    return of


def _byte_names() -> np.ndarray:
    """The character that byte-level vocabularies write for each byte: its own if that is seen, else one of those from U+0100 on."""
    names = np.arange(256, dtype="<u4")
    unseen = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE)]
    names[unseen] = 256 + np.arange(len(unseen))
    names[0x20] = 0x20  # between parts; no part has one
    return names


BETWEEN, LETTER, DIGIT, MARK, OTHER = range(5)
CLASSES, BYTE_NAMES = _classes(), _byte_names()
#: Pairs of bytes that no plain word has: the signs of multiplication and division, the capital I with a dot, what begins a special token.
NOT_PLAIN = ("\u00d7".encode(), "\u00f7".encode(), "\u0130".encode(), b"<|")
#: What plain words are read by; a vocabulary prepared in another way gets each word as it is.
PLAIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters of plain words that are encoded together, about.
TOGETHER = 2_000


class PlainWords:
    """Ids of words of letters, digits and marks whose parts are plain to see, many words at a time.

    Plain are ASCII without apostrophes and special tokens, Latin letters up to U+024F and Cyrillic ones up to U+047F: nothing in
    them joins under NFC, each becomes small by itself, and a part is a run of letters, a run of marks or a digit. So the parts
    are told by the classes of bytes, and the tokenizer's model gets them in small letters with spaces between. Each part's
    last id, and no other, is one of an end of a word.
    """

    def __init__(self, tokenizer, remembered: int):
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer(tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        #: Ids of parts in small letters, met of late and before.
        self.parts = Recent(remembered)

    @staticmethod
    def fits(tokenizer) -> bool:
        """Whether the tokenizer prepares words as is assumed here."""
        made = json.loads(tokenizer.to_str())
        steps = [{k: v for k, v in step.items() if k != "trim_offsets"} for step in (made["pre_tokenizer"] or {}).get("pretokenizers", [])]
        return (
            [n["type"] for n in (made["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            and steps == [
                {"type": "Split", "pattern": {"Regex": PLAIN_PATTERN}, "behavior": "Removed", "invert": True},
                {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False},
            ]
            and made["post_processor"] is None and made["model"].get("end_of_word_suffix") == "</w>"
            and all(t["content"].startswith("<|") for t in made["added_tokens"])
        )

    @staticmethod
    def among(words: list[bytes]) -> np.ndarray:
        """Which words are plain."""
        joined = np.frombuffer(b" ".join(words), np.uint8)
        odd = CLASSES[joined] == OTHER
        for a, b in NOT_PLAIN:
            odd[:-1] |= (joined[:-1] == a) & (joined[1:] == b)
        starts = np.cumsum([0, *map(len, words[:-1])]) + np.arange(len(words))
        return ~np.logical_or.reduceat(odd, starts)

    def _learn(self, parts: list[str]) -> None:
        text = BYTE_NAMES[np.frombuffer(" ".join(parts).encode(), np.uint8)].tobytes().decode("utf-32-le")
        found = self.model.encode_batch_fast(list(_chunks(text)), add_special_tokens=False)
        flat = np.fromiter(chain.from_iterable(f.ids for f in found), "<u4")
        ends = (np.flatnonzero(self.ends[flat]) + 1) * 4
        if len(ends) != len(parts):
            raise ValueError(f"{len(parts)} parts of words have {len(ends)} ends")
        raw, begin = flat.tobytes(), 0
        for part, end in zip(parts, ends.tolist()):
            self.parts.known[part] = raw[begin:end]
            begin = end

    def ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain words in a row, and how many each has."""
        joined = np.frombuffer(b" ".join(words), np.uint8)
        kind = CLASSES[joined]
        within = (kind[1:] != BETWEEN) & (kind[:-1] != BETWEEN)
        begins = within & ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT))  # parts that begin inside a word
        copies = np.ones(len(joined), dtype=np.int64)
        copies[1:] += begins
        parted = np.repeat(joined, copies)
        at = np.flatnonzero(begins)
        parted[at + 1 + np.arange(len(at))] = 0x20
        codes, distinct = pd.factorize(np.array(parted.tobytes().decode().lower().split(" "), dtype=object))
        known = self.parts.of(distinct)
        self._learn([p for p in distinct if p not in known])
        per = [known[p] for p in distinct]
        n = np.fromiter(map(len, per), np.int64, len(per)) // 4
        flat = gathered(np.frombuffer(b"".join(per), "<u4"), np.cumsum(n) - n, n, codes)
        # A word's parts: one more than begin inside it.
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        last = np.cumsum(lengths) + np.arange(len(words)) - 1
        parts = np.concatenate(([0], np.cumsum(begins)))[last] + 1 + np.arange(len(words))
        return flat, np.diff(np.cumsum(n[codes])[parts - 1], prepend=0)


def gathered(flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that ``codes`` number, one after the other."""
    n = lengths[codes]
    before = np.cumsum(n) - n
    return flat[np.repeat(begins[codes] - before, n) + np.arange(n.sum())]


def _chunks(text: str) -> Iterator[str]:
    """A text in pieces that end before a space."""
    start = 0
    while start < len(text):
        stop = text.find(" ", start + TOGETHER)
        stop = len(text) if stop < 0 else stop
        yield text[start:stop]
        start = stop + 1


class WordTokens:
    """Ids of words between white space.

    No token of the vocabulary spans white space, so ids of a text are those of its words
    in a row. A block's distinct plain words are encoded together. Of others, parts are remembered: none spans a letter or
    digit and a mark after it, so where a word ends in letters or digits and then marks, the two parts are remembered
    apart. Whether a word is taken apart depends on the word alone, never on what was seen before. Ids are kept as bytes,
    four each, the lowest first.
    """

    MARKS = b"!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.plain = PlainWords(self.tokenizer, remembered) if PlainWords.fits(self.tokenizer) else None
        #: Parts of other words by their bytes, met of late and before.
        self.parts = Recent(remembered)

    def _core(self, word: bytes) -> bytes:
        """The beginning of a word that ends in marks which is a letter or digit to its end; nothing where the word is taken whole."""
        core = word.rstrip(self.MARKS)
        last = core[-1:]
        if not last or b"<|" in core:  # a special token may end in marks
            return b""
        if last < b"\x80":
            return core if last.isalnum() else b""
        # Beyond ASCII: a letter of an alphabet without joining marks, which stays one in lower case.
        letter = core.decode("utf-8", "surrogatepass")[-1]
        return core if letter < "\u0590" and letter.isalpha() and letter.lower()[-1].isalpha() else b""

    def _learn(self, parts: list[bytes]) -> None:
        texts = [w.decode("utf-8", "surrogatepass") for w in parts]
        for part, found in zip(parts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            self.parts.known[part] = array("I", found.ids).tobytes()

    def _others(self, words: list[bytes]) -> list[bytes]:
        """Ids of each of the distinct ``words``."""
        marks = self.MARKS
        cores = [self._core(w) if w[-1] in marks else w for w in words]
        # Case doesn't matter in ASCII; elsewhere a mark may join small letters only.
        firsts = [(c.lower() if c.isascii() else c) if c else w for c, w in zip(cores, words)]
        rests = [w[len(c):] if c else b"" for c, w in zip(cores, words)]
        needed = set(firsts)
        needed.update(rests)
        needed.discard(b"")
        known = self.parts.of(needed)
        self._learn([w for w in needed if w not in known])
        return [known[a] + known[b] if b else known[a] for a, b in zip(firsts, rests)]

    def ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the distinct ``words``, where each word's begin, and how many it has."""
        begins, lengths = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        plain = PlainWords.among(words) if self.plain and words else np.zeros(len(words), dtype=bool)
        flats, at = [], 0
        if plain.any():
            flat, n = self.plain.ids(list(compress(words, plain)))
            flats.append(flat)
            lengths[plain], begins[plain], at = n, np.cumsum(n) - n, len(flat)
        per = self._others(list(compress(words, ~plain)))
        n = np.fromiter(map(len, per), np.int64, len(per)) // 4
        flats.append(np.frombuffer(b"".join(per), "<u4"))
        lengths[~plain], begins[~plain] = n, at + np.cumsum(n) - n
        return np.concatenate(flats), begins, lengths

    def documents(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, in order."""
        words = Words(texts)
        flat, begins, lengths = self.ids(words.distinct)
        for a, b in blocks(texts, GATHERED_CHARS):
            first, last = words.bounds[a], words.bounds[b]
            codes = words.codes[first:last]
            every = gathered(flat, begins, lengths, codes)
            ends = np.concatenate(([0], np.cumsum(lengths[codes])))[words.bounds[a:b + 1] - first]
            for i in range(b - a):
                yield every[ends[i]:ends[i + 1]]


def _tokens(path: str) -> WordTokens:
    return once(("word tokens", path), lambda: WordTokens(path))


def pieces(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 (of its ids as little-endian 32-bit numbers). Small blocks take less
    memory and more time."""
    path = path or vocabulary_path()

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = _tokens(path)
        for batch in batches:
            texts, ids = batch["t"].tolist(), batch["d"].tolist()
            for a, b in blocks(texts, block_chars):
                rows = []
                for key, found in zip(ids[a:b], tokens.documents(texts[a:b])):
                    whole = np.append(found, np.uint32(END_ID)).astype("<u4")
                    for k, start in enumerate(range(0, len(whole), capacity)):
                        part = whole[start:start + capacity]
                        rows.append((key, k, start, len(part), zlib.crc32(part.tobytes())))
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    narrow = documents.select(F.col(doc_id).cast("long").alias("d"), text_or_empty(F.col(text)).alias("t"))
    return narrow.mapInPandas(giving_back(cut_up), PIECES)


class OpenBins:
    """Bins by free space: bit f of ``free`` is set if a bin with f places free is open."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.free, self.open = 0, 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.next = 0

    def _take(self, space: int) -> int:
        number = self.bins[space].pop()
        if not self.bins[space]:
            self.free &= ~(1 << space)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """The bin and the place in it of a piece: the open bin in which least space is left over, else a new one."""
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            if self.open >= self.most:  # the fullest closes: the lowest set bit
                self._take((self.free & -self.free).bit_length() - 1)
            number, space = self.next, self.capacity
            self.next += 1
        left = space - length
        if left:
            self.bins[left].append(number)
            self.free |= 1 << left
            self.open += 1
        return number, self.capacity - space


def pack(cut_up: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, task_pieces: int = TASK_PIECES) -> DataFrame:
    """Every piece with sequence_id and offset.

    Whole pieces of the capacity are sequences of their own. The rest is dealt over tasks
    by a hash of the row, and each task places its pieces from the longest to the
    shortest. A task's memory is its open bins. With ``open_bins`` for all of a task's
    pieces no bin closes with places free, and little more than the last bins of each
    task stays partly filled. Equal rows are in one task: only where they make it longer
    than ``open_bins`` does the fullest close early, its free places lost.
    """
    tasks = max(1, round(cut_up.count() / task_pieces))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins: dict[int, OpenBins] = {}
        for batch in batches:
            numbers, offsets = [], []
            for part, length in zip(batch["part"].tolist(), batch["length"].tolist()):
                if part not in bins:
                    bins.clear()  # parts come one after the other
                    bins[part] = OpenBins(capacity, open_bins)
                number, offset = bins[part].place(length)
                numbers.append((part << 40) + number)
                offsets.append(offset)
            batch["sequence_id"], batch["offset"] = np.array(numbers, dtype=np.int64), np.array(offsets, dtype=np.int64)
            yield batch.drop(columns="part")

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    dealt = cut_up.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(7)), F.lit(tasks)))
    ordered = dealt.repartition(tasks, "part").sortWithinPartitions("part", F.desc("length"), "doc_id", "piece", "ids_crc32")
    return ordered.select("part", *columns).mapInPandas(giving_back(place), f"{PIECES}, sequence_id bigint, offset bigint")


def packed(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece with the end id alone. Repeated rows are packed as often
    as they occur; a null id stays null. An empty table gives an empty result. Pieces are
    cut off from their lineage, so no text is tokenised twice.
    """
    return pack(cut(pieces(documents, doc_id, text, path, capacity, block_chars)), capacity)


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))


QUERIES = {"op9_best_fit_packing": op9_best_fit_packing}
