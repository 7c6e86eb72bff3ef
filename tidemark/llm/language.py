"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
A word (a run of letters, lower-cased, behind the vocabulary's space mark) has
the sum of the products of its pieces' probabilities over all ways to cut it
into pieces, which a forward algorithm gives without listing them; a character
without a piece of its own goes by the pieces of its bytes. No piece crosses a
word's start, so a text's sum over all segmentations is the product over its
words. The language of highest posterior wins.

Fitting is expectation maximisation: a backward pass beside the forward one
gives how often each piece is expected in the words of each language, tasks sum
these as whole numbers, and the sums are the next probabilities. It uses, of
each language, about ``FIT_TEXTS`` distinct labelled texts, chosen by the hash
of the text, so copies count once; a language with fewer gives all of them. Scoring
takes every whole text: words are tallied by task, each distinct word that a
task remembers is summed once, and nothing is shuffled.

Cases: a null text, or one without a letter, is ``und`` with score 0; a row
without an id is not held out and not learned from; very long texts are scored
whole, and a run of letters of any length is one word (fitting leaves out those
of more than ``FIT_WORD`` letters); equal posteriors go to the language that
comes first by name; copies have equal predictions; repeated rows are scored
row by row; without labelled texts every row is ``und``; an empty table gives
an empty table; other columns are ignored, whatever their names. More than
``MOST_LANGUAGES`` label values fail, as the table of all pieces by languages
is broadcast.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut

FIT_TEXTS, FIT_WORD, ROUNDS = 1000, 40, 3
MOST_LANGUAGES = 1000
#: Added to the expected count of each piece.
SMOOTHING = 0.01
#: Words that a task remembers, and characters of documents that it takes together.
MEMO, CHARS, TOGETHER = 300_000, 4_000_000, 10_000
#: Expected counts are summed in whole parts of this size.
PARTS = 1 << 20
#: Odd numbers of the hash, and the bits that its slots leave out.
BASE, SALT, MIX, SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD), np.uint64(46)
WORD = re.compile(r"[^\W\d_]+")
#: Where a word's scale is moved, sums of earlier ends are kept up to this many times the last one's.
FAR = 1e250
SPACE = "▁"
UNKNOWN = "und"


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Pieces:
    """A fixed vocabulary: numbers of its pieces, and of the bytes' pieces.

    Substrings of many words are looked up at once, by 64-bit hashes: the
    pieces lie in slots by the top bits of theirs.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [library.id_to_piece(i) for i in range(library.vocab_size())]
        special = [library.is_byte(i) or library.is_control(i) or library.is_unknown(i) for i in range(len(names))]
        self.size = len(names)
        self.number = {p: i for i, p in enumerate(names) if not special[i] and re.fullmatch(rf"{SPACE}?[^\W\d_]*", p)}
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(names) if library.is_byte(i)}
        self.longest = max(map(len, self.number))
        self.powers = np.cumprod(np.array([1, *[BASE] * self.longest], np.uint64))
        self.hashes = np.zeros(self.size + 1, np.uint64)
        for group in by_length(self.number):
            self.hashes[[self.number[p] for p in group]] = prefixes(letters(group))[:, -1]
        ids = np.fromiter(self.number.values(), np.int64)
        if len(np.unique(self.hashes[ids])) != len(ids):
            raise ValueError("two pieces have one hash")
        slot = self.hashes[ids] * MIX >> SHIFT
        order = np.argsort(slot, kind="stable")
        names, first, times = np.unique(slot[order], return_index=True, return_counts=True)
        self.slots = np.full((times.max(), 1 << (64 - int(SHIFT))), self.size, np.int32)
        for depth in range(times.max()):
            some = times > depth
            self.slots[depth, names[some]] = ids[order[first[some] + depth]]

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, ``size`` where there is none."""
        slot, out = hashes * MIX >> SHIFT, np.full(len(hashes), self.size, np.int32)
        for row in self.slots:
            held = row[slot]
            np.copyto(out, held, where=(self.hashes[held] == hashes) & (held != self.size))
        return out

    def edges(self, words: list[str]) -> tuple[dict[tuple[int, int], np.ndarray], list[list[int]]]:
        """For words of one length, by start and end the numbers of the pieces there (``size``: none), and the bytes of those numbered ``size`` + 1 and on."""
        n = len(words[0]) + 1
        codes = letters([SPACE + w for w in words])
        ahead = prefixes(codes)
        out, unknown = {}, np.zeros(0, np.uint32)
        for j in range(1, n + 1):
            for i in range(max(0, j - self.longest), j):
                found = self.find(ahead[:, j] - ahead[:, i] * self.powers[j - i])
                if (found != self.size).any():
                    out[i, j] = found
        single = [np.where(out[j - 1, j] == self.size, codes[:, j - 1], 0) if (j - 1, j) in out else codes[:, j - 1] for j in range(2, n + 1)]
        unknown = np.unique(np.concatenate(single)) if single else unknown
        unknown = unknown[unknown > 0]
        if len(unknown):
            for j, own in enumerate(single, 2):
                at = np.searchsorted(unknown, own).astype(np.int32)
                out[j - 1, j] = np.where(own > 0, self.size + 1 + at, out.get((j - 1, j), self.size))
        return out, [[self.byte[b] for b in chr(c).encode()] for c in unknown]


def letters(words: list[str]) -> np.ndarray:
    """The characters of words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)


def prefixes(codes: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all beginnings of rows of characters, modulo 2**64."""
    out = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
    for j in range(codes.shape[1]):
        out[:, j + 1] = out[:, j] * BASE + (codes[:, j].astype(np.uint64) + np.uint64(1)) * SALT
    return out


def with_bytes(table: np.ndarray, spelled: list[list[int]]) -> np.ndarray:
    """The probabilities of all pieces, then of none, then of characters by their bytes."""
    return np.concatenate([table, np.zeros((1, table.shape[1])), *(table[b].prod(axis=0, keepdims=True) for b in spelled)])


def by_length(words) -> Iterator[list[str]]:
    """Words of one length together, some ten thousand at most."""
    groups = defaultdict(list)
    for w in words:
        groups[len(w)].append(w)
    for group in groups.values():
        yield from (group[a : a + TOGETHER] for a in range(0, len(group), TOGETHER))


def log_probabilities(words: list[str], pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """For words of one length the logarithm of the sum over all segmentations, by language."""
    edges, spelled = pieces.edges(words)
    known = with_bytes(table, spelled)
    n = len(words[0]) + 1
    forward = {0: np.ones((len(words), table.shape[1]))}
    scale = np.zeros_like(forward[0])
    for j in range(1, n + 1):
        forward.pop(j - 1 - pieces.longest, None)
        total = np.zeros_like(scale)
        for i in range(max(0, j - pieces.longest), j):
            if (at := edges.get((i, j))) is not None:
                total += forward[i] * known[at]
        forward[j] = total
        if j % 4 == 0:  # four characters keep far from the smallest doubles
            scale += np.log(total)
            for i in forward:
                forward[i] = np.minimum(forward[i], total * FAR) / total
    return np.round(scale + np.log(forward[n]), 9)


def expected(words: list[str], weights: np.ndarray, pieces: Pieces, table: np.ndarray, into: np.ndarray) -> None:
    """Adds to ``into`` the expected pieces of words of one length, which the languages have ``weights`` times."""
    edges, spelled = pieces.edges(words)
    known, n = with_bytes(table, spelled), len(words[0]) + 1
    forward, backward = ([np.zeros((len(words), table.shape[1])) for _ in range(n + 1)] for _ in range(2))
    forward[0] += 1
    backward[n] += 1
    for (i, j), at in sorted(edges.items(), key=lambda e: e[0][1]):
        forward[j] += forward[i] * known[at]
    for (i, j), at in sorted(edges.items(), key=lambda e: -e[0][0]):
        backward[i] += known[at] * backward[j]
    share = weights / np.where(forward[n] > 0, forward[n], 1)
    flat, columns = into.reshape(-1), np.arange(into.shape[1])
    for (i, j), at in edges.items():
        parts = np.rint(PARTS * share * forward[i] * known[at] * backward[j]).astype(np.int64)
        plain = at < pieces.size
        np.add.at(flat, (at[plain, None].astype(np.int64) * len(columns) + columns).ravel(), parts[plain].ravel())
        for k in np.flatnonzero(at > pieces.size):
            for b in spelled[at[k] - pieces.size - 1]:
                into[b] += parts[k]


class Model:
    def __init__(self, languages: list[str], prior: np.ndarray, table: np.ndarray, vocabulary: bytes):
        self.languages, self.prior, self.table, self.vocabulary = languages, prior, table, vocabulary


def remainder(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3))


def _tally(batches):
    for batch in batches:
        tally: Counter = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), (x.as_py() for x in batch.column(1)), strict=True):
            tally.update((lang, w) for w in words_of(text) if len(w) <= FIT_WORD)
        langs, words = zip(*tally, strict=True) if tally else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(tally.values(), pa.int64())], names=["lang", "word", "n"])


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, texts: int) -> tuple[DataFrame, dict[str, int]]:
    """Words by language of the texts to fit on, and the number of distinct texts of each language."""
    labelled = docs.filter((remainder(id_col) != 1) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    share = F.coalesce(*(F.when(F.col("lang") == k, F.lit(min(1.0, texts / n))) for k, n in sizes.items()), F.lit(0.0))
    chosen = labelled.filter(F.pmod("h", F.lit(1 << 20)) < share * (1 << 20)).dropDuplicates(["lang", "h"])
    return chosen.select("lang", "text").mapInArrow(_tally, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), sizes


def fit(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", texts: int = FIT_TEXTS, rounds: int = ROUNDS) -> Model:
    """Piece probabilities of each language from rows whose remainder is not 1. The start counts all pieces in all words; each round is one job over the words."""
    with open(vocabulary_path, "rb") as f:
        vocabulary = f.read()
    words, sizes = sample(docs, id_col, text_col, lang_col, texts)
    languages, size = sorted(sizes), Pieces(vocabulary).size
    if not languages:
        return Model([], np.zeros(0), np.zeros((size, 0)), vocabulary)
    weights = F.array(*(F.coalesce(F.sum(F.when(F.col("lang") == k, F.col("n"))), F.lit(0)) for k in languages))
    stored = cut(words.groupBy("word").agg(weights.alias("n")), "words")
    context = docs.sparkSession.sparkContext

    def counts(table: np.ndarray | None) -> np.ndarray:
        shared = context.broadcast((vocabulary, table))

        def expect(batches):
            pieces = Pieces(shared.value[0])
            table = np.ones((size, len(languages))) if shared.value[1] is None else shared.value[1]
            total = np.zeros((size, len(languages)), np.int64)
            for batch in batches:
                own = dict(zip(batch.column(0).to_pylist(), batch.column(1).flatten().to_numpy().reshape(-1, len(languages)), strict=True))
                for group in by_length(own):
                    expected(group, np.array([own[w] for w in group]), pieces, table, total)
            some = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * len(languages), pa.int32()), pa.array(total[some].ravel()))], names=["piece", "n"])

        parts = stored.repartition(max(1, context.defaultParallelism)).mapInArrow(expect, "piece long, n array<long>")
        sums = parts.groupBy("piece").agg(F.array(*(F.sum(F.col("n")[k]) for k in range(len(languages)))).alias("n"))
        out = np.zeros((size, len(languages)))
        for r in sums.collect():  # at most a row for each piece of the vocabulary
            out[r["piece"]] = r["n"]
        shared.unpersist()
        smooth = out / PARTS + SMOOTHING
        return smooth / smooth.sum(axis=0)

    table = counts(None)
    for _ in range(rounds):
        table = counts(table)
    prior = np.array([sizes[k] for k in languages], float)
    return Model(languages, np.log(prior / prior.sum()), table, vocabulary)


class Scorer:
    """Predictions of texts; remembers the words that it has summed."""

    def __init__(self, model: Model):
        self.model, self.pieces = model, Pieces(model.vocabulary)
        self.number: dict[str, int] = {}
        self.rows = np.zeros((0, len(model.languages)))

    def learn(self, words) -> None:
        fresh = [w for w in words if w not in self.number]
        if len(self.number) + len(fresh) > MEMO:
            self.number, self.rows, fresh = {}, self.rows[:0], list(words)
        parts = [self.rows]
        for group in by_length(fresh):
            self.number |= zip(group, count(len(self.number)), strict=False)
            parts.append(log_probabilities(group, self.pieces, self.model.table))
        self.rows = np.concatenate(parts)

    def score(self, texts: list[list[str]]) -> list[tuple[str, float]]:
        self.learn(dict.fromkeys(w for words in texts for w in words))
        out = []
        for words in texts:
            if not self.model.languages or not any(w[0].isalpha() or any(map(str.isalpha, w)) for w in words):
                out.append((UNKNOWN, 0.0))
                continue
            total = self.model.prior + self.rows[np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))].sum(axis=0)
            best = int(total.argmax())
            out.append((self.model.languages[best], round(float(1 / np.exp(total - total[best]).sum()), 9)))
        return out


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), the score being the posterior of the prediction."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            ids, held, texts = batch.columns
            a, chars, words = 0, 0, []
            for b in range(batch.num_rows):
                text = texts[b].as_py() or ""
                words.append(words_of(text))
                chars += len(text)
                if chars >= CHARS or b == batch.num_rows - 1:
                    lang, score = zip(*scorer.score(words), strict=True)
                    yield pa.RecordBatch.from_arrays([ids[a : b + 1], held[a : b + 1], pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])
                    a, chars, words = b + 1, 0, []

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(remainder(id_col) == 1, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
