"""Language identification by unigrams of a fixed public vocabulary, summed over all segmentations.

Each language has a probability for every piece of the vocabulary. A word can be cut into pieces in many ways; a forward
pass sums the products of the piece probabilities over all of them. A text's words add up their log sums, and Bayes'
rule over the languages gives the prediction with its probability.

The pass runs over the distinct words of a slice of texts at once: all vocabulary pieces inside all words are found by
hashing, and the sums advance by one byte position at a time for all words and languages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.llm.columnar import Spans, runs
from fieldlens.llm.common import held_out, materialise

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLE, FOLDS, FOLD = 3000, 4, 2
SMOOTH, FLOOR = 0.5, 1e-6
UNKNOWN = "und"
_SLICE, _CACHE, _BITS = 4 << 20, 400_000, 22
_WORDS = 20_000  # words of one forward pass
_PARTS = 16  # bits of the hash that name a range
_OTHER = re.compile(r"[\W\d_]+")
_MARK = "▁"


def _slices(column: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """(rows, texts) of bounded size; a very long text comes in parts cut at blanks, never inside a word."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    for i, j in runs(offsets, 1 << 20, _SLICE):
        if offsets[j] - offsets[i] <= 2 * _SLICE:
            yield np.arange(i, j), pc.fill_null(column.slice(i, j - i), "")
            continue
        text, at = column[i].as_py(), 0
        while at < len(text):
            end = min(at + _SLICE // 2, len(text))
            if end < len(text):
                cut = text.rfind(" ", at, end) + 1 or text.find(" ", end) + 1
                end = cut or len(text)
            yield np.array([i]), pa.array([text[at:end]])
            at = end


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(text number and word number of every token, distinct raw words)."""
    split = pc.utf8_split_whitespace(pc.utf8_lower(texts))
    of = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    coded = split.flatten().dictionary_encode()
    return of, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()


def letters(word: str) -> str:
    """The word without signs and digits; empty where no letter is left."""
    if word.isalpha():
        return word
    word = _OTHER.sub("", word)
    return word if any(map(str.isalpha, word)) else ""


@dataclass
class Model:
    langs: list[str]
    prior: np.ndarray
    pieces: list[str]
    chance: np.ndarray  # (piece, language)
    _ready: bool = False
    _cache: dict = field(default_factory=dict)

    def __getstate__(self):
        return {"langs": self.langs, "prior": self.prior, "pieces": self.pieces, "chance": self.chance, "_ready": False, "_cache": {}}

    def _prepare(self) -> None:
        data = [p.encode() for p in self.pieces]
        flat, at = np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(d) for d in data])))
        hashes = Spans(flat).of(at[:-1], at[1:])
        order = np.argsort(hashes)
        self._hash, self._chance = hashes[order], self.chance[order]
        self._maybe = np.zeros(1 << _BITS, bool)
        self._maybe[self._hash >> np.uint64(64 - _BITS)] = True
        self._longest = max(map(len, data), default=1)
        self._rows, self._used, self._ready = np.empty((_CACHE + (1 << 20), len(self.langs))), 0, True

    def forward(self, words: list[str]) -> np.ndarray:
        """Log of the sum over all segmentations, per word and language."""
        coded = [(_MARK + w).encode() for w in words]
        data, size = np.frombuffer(b"".join(coded), np.uint8), np.array([len(b) for b in coded])
        start = np.concatenate(([0], np.cumsum(size)))
        word = np.repeat(np.arange(len(size)), size)
        left = start[word + 1] - np.arange(len(data))  # bytes to the end of the word
        first = (data & 0xC0) != 0x80
        spans, begins, ends, chances = Spans(data), [], [], []
        alone = np.where(data < 0x80, 1, np.where(data < 0xE0, 2, np.where(data < 0xF0, 3, 4)))
        free = first.copy()
        for n in range(1, self._longest + 1):
            at = np.flatnonzero(first & (left >= n))
            if not len(at):
                break
            h = spans.of(at, at + n)
            some = self._maybe[h >> np.uint64(64 - _BITS)]
            at, h = at[some], h[some]
            slot = np.minimum(np.searchsorted(self._hash, h), len(self._hash) - 1)
            real = self._hash[slot] == h
            at, slot = at[real], slot[real]
            single = alone[at] == n
            free[at[single]] = False
            begins.append(at)
            ends.append(at + n)
            chances.append(np.where(single[:, None], np.maximum(self._chance[slot], FLOOR), self._chance[slot]))
        at = np.flatnonzero(free)  # signs outside the vocabulary
        begins.append(at)
        ends.append(at + np.minimum(alone[at], left[at]))
        chances.append(np.full((len(at), len(self.langs)), FLOOR))
        begin, end, chance = np.concatenate(begins), np.concatenate(ends), np.concatenate(chances)
        of = word[begin]
        step = end - start[of]
        order = np.lexsort((end, step))
        begin, end, chance, of, step = begin[order], end[order], chance[order], of[order], step[order]
        # a cell for each byte and one more per word: the logs of the sums before the byte
        sums = np.full((len(data) + len(size), len(self.langs)), -np.inf)
        sums[start[:-1] + np.arange(len(size))] = 0
        source, target, chance = begin + of, end + of, np.log(chance)
        cuts = np.flatnonzero(np.diff(step, prepend=-1))
        for a, b in zip(cuts, np.append(cuts[1:], len(step))):
            new = np.flatnonzero(np.diff(target[a:b], prepend=-1))
            terms = sums[source[a:b]] + chance[a:b]
            most = np.maximum.reduceat(terms, new, axis=0)  # finite: every sign is a piece of its own
            rest = np.add.reduceat(np.exp(terms - np.repeat(most, np.diff(np.append(new, b - a)), axis=0)), new, axis=0)
            sums[target[a:b][new]] = most + np.log(rest)
        return sums[start[1:] + np.arange(len(size))]

    def _word_scores(self, raw: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores and whether there is a letter, for raw words; remembered as long as the memory bound allows."""
        if not self._ready:
            self._prepare()
        if self._used > _CACHE:
            self._cache, self._used = {}, 0
        bare = [letters(w) for w in raw]
        new = [w for w in dict.fromkeys(bare) if w and w not in self._cache]
        for a in range(0, len(new), _WORDS):
            part = new[a : a + _WORDS]
            if self._used + len(part) > len(self._rows):
                self._rows = np.concatenate((self._rows, np.empty_like(self._rows)))
            self._rows[self._used : self._used + len(part)] = self.forward(part)
            self._cache.update(zip(part, range(self._used, self._used + len(part))))
            self._used += len(part)
        at = np.array([self._cache[w] if w else -1 for w in bare], np.int64)
        return np.where(at[:, None] >= 0, self._rows[at], 0), at >= 0

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        total, known = np.zeros((len(column), len(self.langs))), np.zeros(len(column), bool)
        for rows, texts in _slices(column):
            of, word, raw = _words(texts)
            if not len(raw):
                continue
            score, real = self._word_scores(raw)
            on = real[word]
            of, word = rows[of[on]], word[on]
            known[of] = True
            for k in range(len(self.langs)):
                total[:, k] += np.bincount(of, weights=score[word, k], minlength=len(column))
        if not self.langs:
            return [UNKNOWN] * len(column), np.zeros(len(column))
        total += self.prior
        best = total.argmax(axis=1)
        share = 1 / np.exp(np.clip(total - total.max(axis=1, keepdims=True), -700, 0)).sum(axis=1)
        return [self.langs[b] if ok else UNKNOWN for b, ok in zip(best, known)], np.where(known, share, 0.0)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE, vocabulary: str = VOCABULARY) -> Model:
    """Piece probabilities from at most ``sample`` documents of each language, those of smallest key hash, outside the held-out fold.

    Priors come from all labelled rows. Pieces are counted in the vocabulary's own segmentation of each word.
    """
    free = docs.where(F.col(lang).isNotNull() & ~held_out(key, FOLDS, FOLD))
    counts = {r[lang]: r["count"] for r in free.groupBy(lang).count().collect()}  # a row per language
    keys = free.select(F.col(key).alias("k"), F.col(lang).alias("lang"), F.xxhash64(key).alias("h"))
    keys = keys.withColumn("part", F.shiftright("h", 64 - _PARTS))
    # a histogram of hash ranges tells the range that the sample ends in; only that one is ranked
    parts = keys.groupBy("lang", "part").count()
    before = F.coalesce(F.sum("count").over(Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = materialise(parts.withColumn("before", before).where(F.col("before") < sample))
    keys = keys.join(parts, ["lang", "part"])
    whole = F.col("before") + F.col("count") <= sample
    last = keys.where(~whole).withColumn("n", F.row_number().over(Window.partitionBy("lang", "part").orderBy("h", "k"))).where(F.col("before") + F.col("n") <= sample)
    keys = keys.where(whole).select("k", "lang").unionByName(last.select("k", "lang"))
    picked = free.select(F.col(key).alias("k"), F.col(lang).alias("lang"), F.col(text).alias("t"))
    picked = picked.join(keys.select("k", "lang").distinct(), ["k", "lang"], "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        cut = SentencePieceProcessor(model_file=vocabulary)
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            known, which = langs.dictionary.to_pylist(), langs.indices.to_numpy(zero_copy_only=False)
            total = np.zeros((len(known), cut.get_piece_size()), np.int64)
            for rows, texts in _slices(batch.column(1)):
                of, word, raw = _words(texts)
                pieces = cut.encode([letters(w) for w in raw], num_threads=1) if raw else []
                first = np.concatenate(([0], np.cumsum([len(p) for p in pieces]))).astype(np.int64)
                flat = np.array([p for own in pieces for p in own], np.int64)
                seen = np.unique(which[rows[of]] * np.int64(len(raw)) + word, return_counts=True)
                for code, n in zip(*seen):
                    lang_of, w = divmod(int(code), len(raw))
                    np.add.at(total[lang_of], flat[first[w] : first[w + 1]], n)
            at = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([known[i] for i in at[0]], pa.string()), pa.array(at[1], pa.int32()), pa.array(total[at])], ["lang", "piece", "n"])

    from sentencepiece import SentencePieceProcessor

    vocab = SentencePieceProcessor(model_file=vocabulary)
    pieces = [vocab.id_to_piece(i) if not (vocab.is_control(i) or vocab.is_byte(i) or vocab.is_unknown(i)) else "" for i in range(vocab.get_piece_size())]
    langs = sorted(counts)
    table = np.zeros((len(pieces), len(langs)))
    if langs:
        seen = picked.select("lang", "t").mapInArrow(count, "lang string, piece int, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        for r in seen.collect():  # at most the vocabulary for each language
            table[r["piece"], langs.index(r["lang"])] = r["n"]
    on = [i for i, p in enumerate(pieces) if p]
    table = table[on] + SMOOTH
    whole = sum(counts.values())
    return Model(langs, np.log([counts[x] / whole for x in langs]) if langs else np.empty(0), [pieces[i] for i in on], table / table.sum(axis=0))


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, held_out, lang_pred, score) for every row; no shuffle of texts.

    Texts that are null or have no letter are ``und`` with score 0, and so is everything where no language was learned. The
    score is the probability of the predicted language among the learned ones. Null languages are not learned from,
    null keys are never held out, repeated rows are predicted each; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, key, text, lang, vocabulary=vocabulary))  # vocabulary x languages

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, score = shared.value.predict(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(score)], ["key", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(key).alias("key"), held_out(key, FOLDS, FOLD).alias("held_out"), F.col(text).alias("text"))
    out = rows.mapInArrow(each, f"key {docs.schema[key].dataType.simpleString()}, held_out boolean, lang_pred string, score double")
    return out.withColumnRenamed("key", key)
