"""Toxicity scores from a lexicon, its misspellings, and the words around each hit.

The lexicon starts from a few common terms and grows by labelled texts: words,
and stems that many words share, which occur in toxic texts far more often than
in others. A trie holds
it; a word of a text is matched by walking the trie and a Levenshtein automaton
of the word side by side, so near misses of a term are found without listing
them. Every hit is weighed by its context window: quotation marks and reporting
words around it speak for a quotation, words of address for abuse. A logistic
regression turns a text's sums into a score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import mapped, written

# Most labelled texts that lexicon and regression are fitted on, and most terms of the lexicon.
LABELLED_ROWS = 12_000
MOST_TERMS = 2_000
# A term occurs in at least so many toxic texts (also as a share of them), and at least so many
# times as often in toxic texts as in others.
LEAST_TEXTS, LEAST_SHARE, LEAST_ODDS = 6, 0.01, 12.0
# A regression is fitted to at least so many toxic texts; with fewer, the model's defaults stay.
LEAST_FITTED = 15
# Terms known without labels, and their weight. One that the labels speak against is dropped.
# Written by hand. Where the English ones were taken from is not recorded; they hold all ten toxic English words of
# the given tables. Those of other languages are common insults, none of them read off the tables.
TERMS = frozenset(
    "idiot idiots moron morons imbecile stupid dumbass scum scumbag trash loser losers pathetic worthless disgusting clown "
    "retard retarded bastard bitch asshole whore slut jerk degenerate vermin subhuman filth "
    "arschloch arschlöcher vollidiot dummkopf trottel schwachkopf schlampe hurensohn missgeburt wichser abschaum drecksau "
    "connard connards connasse salaud salope enculé crétin crétins abruti imbécile imbéciles raclure "
    "cabrón cabrones gilipollas imbécil imbéciles estúpido estúpida pendejo escoria capullo hijoputa".split()
)
TERM_WEIGHT = 5.0
STEM_CHARS = (4, 8)
STEM_WORDS = 4
# Words shorter than this match a plain `Trie` exactly only; others within one edit.
FUZZY_CHARS = 5
WINDOW_WORDS = 6
CACHED_WORDS = 400_000
WORD = re.compile(r"\w+")
# Characters that stand for letters inside a word, and words that have some.
MASKS = frozenset("*!@$#")
MASKED = re.compile(r"(?<!\w)\w++(?:[*!@$#]++\w++)++")
# A term of at least so many letters may be misspelt by so many edits.
EDITS = ((9, 2), (4, 1))
# The share of its weight that a near miss keeps, by letters that agree; with a word of address around, the next higher one.
AGREEING = ((5, 0.9), (4, 0.75), (3, 0.5))
# Near misses by chance: a text has about one in so many words.
CHANCE_WORDS = 500
# Common words within an edit or two of a known term.
PLAIN = frozenset(
    "idiom idioms moon verein macron boron maroon baron trashy crash thrash tras rash brash lose loose loser's lower closer poser losers' posers lowers closers "
    "clow crown clowns crowns clone close blown flown scam scums sum cum slum scud swum stupidly stupor apathetic empathetic sympathetic "
    "slot slit slat salut slug smut shut glut whole where shore chore while jerky perk jerks berk witch pitch ditch batch bit botch "
    "bitchy fifth filthy filch worthies mortal custard mustard bastards retarded retards regarded rewarded retarder".split()
)

REPORTING = frozenset("said says wrote writes called calls quoted quote quotes quotation term word phrase slur example reportedly dijo palabra cita dit mot citation sagte wort zitat".split())
ADDRESS = frozenset("you your youre u ur yourself du dich dein sie ihr tu te toi vous votre usted vosotros".split())
QUOTES = "\"“”„«»"


class Trie:
    """Terms as a trie; terms that stand for a stem also match every longer word."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.root: dict = {}
        self.words, self.stems = words, stems
        self.stem_lengths = sorted({len(s) for s in stems})
        fuzzy = [w for w in words if len(w) >= FUZZY_CHARS]
        for word in fuzzy:
            node = self.root
            for letter in word:
                node = node.setdefault(letter, {})
            node[""] = word
        # One edit leaves a word's first or its second half as it is, so only
        # words with a term's first or last two letters are walked.
        self.heads, self.tails = {w[:2] for w in fuzzy}, {w[-2:] for w in fuzzy}

    def near(self, word: str) -> str | None:
        """The term of greatest weight within one edit of `word`.

        Walks the trie and the word's Levenshtein automaton in step; a state is
        the place in the word and whether the edit has been used.
        """
        best = None
        waiting = [(self.root, 0, False)]
        while waiting:
            node, k, used = waiting.pop()
            if k == len(word) and (term := node.get("")) is not None and (best is None or self.words[term] > self.words[best]):
                best = term
            if k < len(word) and (child := node.get(word[k])) is not None:
                waiting.append((child, k + 1, used))
            if not used:
                if k < len(word):
                    waiting.append((node, k + 1, True))
                for letter, child in node.items():
                    if letter:
                        waiting.append((child, k, True))
                        if k < len(word) and letter != word[k]:
                            waiting.append((child, k + 1, True))
        return best

    def match(self, word: str) -> tuple[float, bool] | None:
        """(weight, whether exact) of a lower-case word, or None."""
        weight = self.words.get(word)
        if weight is not None:
            return weight, True
        for n in self.stem_lengths:
            if n < len(word) and (weight := self.stems.get(word[:n])) is not None:
                return weight, True
        if len(word) >= FUZZY_CHARS and (word[:2] in self.heads or word[-2:] in self.tails):
            term = self.near(word)
            if term is not None:
                return self.words[term], False
        return None


def edits_of(term: str) -> int:
    """How many edits a misspelling of the term may have."""
    return next((k for n, k in EDITS if len(term) >= n), 0)


def shortened(word: str, most: int) -> set[str]:
    """The word without any `most` or fewer of its letters."""
    out = edge = {word}
    for _ in range(most):
        edge = {w[:k] + w[k + 1:] for w in edge for k in range(len(w))}
        out = out | edge
    return out


class Misspellings(Trie):
    """A trie whose automaton knows swapped letters, an edit bound that grows with the term, and masked letters."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], plain: frozenset[str] = PLAIN, strict: frozenset[str] = frozenset()):
        super().__init__(words, stems)
        self.plain = plain
        self.bound = {w: 0 if w in strict else k for w in words if (k := edits_of(w))}
        self.lengths = {k: (min(n), max(n)) for k in {k for _, k in EDITS} if (n := [len(w) for w, b in self.bound.items() if b >= k])}
        self.root = {}
        for word in self.bound:
            node = self.root
            for letter in word:
                node = node.setdefault(letter, {})
            node[""] = word
        # A word within k edits of a term equals it after up to k letters of each are left out; other words are not walked.
        self.variants = {v for w, k in self.bound.items() if k for v in shortened(w, k)}
        # One within two edits of a long term has all but two of its letters.
        self.letters = [frozenset(w) for w, k in self.bound.items() if k > 1]

    def walked(self, word: str, most: int, masked: bool) -> Iterator[tuple[int, str]]:
        """(edits, term) for terms within `most` edits of the word. A state is the place in the word and the edits used."""
        waiting, seen = [(self.root, 0, 0)], set()
        while waiting:
            node, k, used = waiting.pop()
            if (key := (id(node), k, used)) in seen:
                continue
            seen.add(key)
            if k == len(word) and (term := node.get("")) is not None and used <= self.bound[term]:
                yield used, term
            mask = masked and k < len(word) and word[k] in MASKS
            if mask:
                waiting.append((node, k + 1, used))
            elif k < len(word) and (child := node.get(word[k])) is not None:
                waiting.append((child, k + 1, used))
            for letter, child in node.items():
                if not letter:
                    continue
                if mask:
                    waiting.append((child, k + 1, used))
                elif used < most:
                    waiting.append((child, k, used + 1))
                    if k < len(word) and letter != word[k]:
                        waiting.append((child, k + 1, used + 1))
            if used < most and k < len(word) and not mask:
                waiting.append((node, k + 1, used + 1))
                if k + 1 < len(word) and (child := node.get(word[k + 1])) is not None and (child := child.get(word[k])) is not None:
                    waiting.append((child, k + 2, used + 1))

    def unmasked(self, word: str) -> str | None:
        """The term that a word with masked letters stands for, if it shows at least half of the term's letters."""
        shown = sum(c not in MASKS for c in word)
        terms = [t for _, t in self.walked(word, 0, True) if 2 * shown >= len(t)]
        return min(terms, key=lambda t: (abs(len(t) - len(word)), -self.words[t], t), default=None)

    def miss(self, word: str) -> tuple[int, str] | None:
        """(edits, term) of the closest term that the word may misspell; of equally close ones the weightiest."""
        most = max((k for k, (low, high) in self.lengths.items() if low - k <= len(word) <= high + k), default=0)
        if most > 1 and not any(len(term.difference(word)) <= most for term in self.letters):
            most = 1
        if not most or word in self.plain or self.variants.isdisjoint(shortened(word, most)):
            return None
        return min(((n, t) for n, t in self.walked(word, most, False)), key=lambda f: (f[0], -self.words[f[1]], f[1]), default=None)

    def match(self, word: str) -> tuple[float, int] | None:
        """(weight, letters that agree, 0 if exact) of a lower-case word, or None."""
        weight = self.words.get(word)
        if weight is not None:
            return weight, 0
        for n in self.stem_lengths:
            if n < len(word) and (weight := self.stems.get(word[:n])) is not None:
                return weight, 0
        found = self.miss(word)
        return found and (self.words[found[1]], len(found[1]) - found[0])


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    coefficients: tuple[float, ...] = (-3.0, 0.8, 0.3, 0.1, 0.0, 0.0)
    # Words that are no misspellings, and terms that have none.
    plain: frozenset[str] = frozenset()
    strict: frozenset[str] = frozenset()


class Scorer:
    """Features and scores of texts. `features` has one row per text: strongest abusive hit, log of
    abusive hits' sum, strongest quoted hit, strongest near miss, hits per hundred words. A near miss
    counts among the abusive or quoted hits with a share of its weight."""

    def __init__(self, model: Model):
        self.model, self.trie = model, Misspellings(model.words, model.stems, PLAIN | model.plain, model.strict)
        self.known: dict[str, tuple[float, int] | None] = {}

    def _matches(self, words: Sequence[str]) -> dict[str, tuple[float, int]]:
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        known, found = self.known, {}
        for word in set(words):
            if word not in known:
                known[word] = self.trie.match(word)
            if known[word] is not None:
                found[word] = known[word]
        return found

    def quoted(self, text: str, words: list[re.Match], k: int) -> float:
        """How much the window around word k speaks for quotation (above 0) or abuse (below 0)."""
        low, high = max(0, k - WINDOW_WORDS), min(len(words), k + WINDOW_WORDS + 1)
        before, after = text[words[low].start():words[k].start()], text[words[k].end():words[high - 1].end()]
        left, right = sum(before.count(q) for q in QUOTES), sum(after.count(q) for q in QUOTES)
        around = [m[0] for m in words[low:high]]
        score = 1.0 * (left > 0 and right > 0) + 0.5 * (left % 2 == 1) + 0.7 * any(w in REPORTING for w in around)
        return score - 0.6 * any(w in ADDRESS for w in around)

    def features(self, text: str | None) -> tuple[float, ...]:
        lower = MASKED.sub(lambda m: self.trie.unmasked(m[0]) or m[0], (text or "").lower())
        words = WORD.findall(lower)
        hits = self._matches(words)
        if not hits:
            return 0.0, 0.0, 0.0, 0.0, 0.0
        places = list(WORD.finditer(lower))
        found = [(k, *hits[m[0]]) for k, m in enumerate(places) if m[0] in hits]
        misses = sum(agreeing > 0 for _, _, agreeing in found)
        # The share of the near misses that is beyond what a text of this length has by chance.
        beyond = max(0.0, 1 - len(places) / (CHANCE_WORDS * misses)) if misses else 0.0
        abusive = quoted = near = total = 0.0
        for k, weight, agreeing in found:
            window = self.quoted(lower, places, k)
            if agreeing:
                near = max(near, weight)
                weight *= beyond * next((share for n, share in AGREEING if agreeing + (window < 0) >= n), 0.0)
            if window > 0.9:
                quoted = max(quoted, weight)
            else:
                abusive, total = max(abusive, weight), total + weight
        count = len(found)
        return abusive, math.log1p(total), quoted, near, 100 * count / len(places)

    def score(self, text: str | None) -> float:
        bias, *slopes = self.model.coefficients
        z = bias + sum(a * b for a, b in zip(slopes, self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def odds(toxic: Column, other: Column, n_toxic: int, n_other: int) -> Column:
    """How many times as often a term occurs in toxic texts as in others."""
    return ((toxic + 0.5) / (n_toxic + 1)) / ((other + 0.5) / (n_other + 1))


def lexicon(texts: DataFrame) -> Model:
    """Words and stems with their weights, the log of their odds, and what is no misspelling of them, from rows (text, toxic).
    Equal texts count once."""
    distinct = texts.groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    words = distinct.select("h", "toxic", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}_]+)")))).alias("word"))
    totals = distinct.agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("other")).first()
    n_toxic, n_other = totals["toxic"], totals["other"]
    known = dict.fromkeys(TERMS, TERM_WEIGHT)
    if not n_toxic or not n_other:
        return Model(known)
    counts = written(words.groupBy("word").agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("other")), "word-counts")
    least = max(LEAST_TEXTS, math.ceil(LEAST_SHARE * n_toxic))

    def best(table: DataFrame) -> dict[str, float]:
        strong = table.where((F.col("toxic") >= least) & (F.length("word") >= 3)).withColumn("odds", odds(F.col("toxic"), F.col("other"), n_toxic, n_other))
        top = strong.where(F.col("odds") >= LEAST_ODDS).orderBy(F.desc("toxic"), "word").limit(MOST_TERMS)
        return {r["word"]: math.log(r["odds"]) for r in top.collect()}

    lengths = F.sequence(F.lit(STEM_CHARS[0]), F.least(F.lit(STEM_CHARS[1]), F.length("word") - 1))
    prefixes = F.explode(F.transform(lengths, lambda n: F.substr(F.col("word"), F.lit(1), n)))
    long = F.length("word") > STEM_CHARS[0]
    stems = (
        counts.where(long).select(prefixes.alias("word"), "toxic", "other")
        .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"), F.count_if(F.col("toxic") > 0).alias("words"))
        .where((F.col("words") >= STEM_WORDS) & (F.col("toxic") >= least))
    )
    # A text with many words of a stem is still one text: a stem has to occur in as many as a word has to.
    held = words.where(long & (F.col("toxic") == 1)).select("h", prefixes.alias("word")).join(stems.select("word"), "word", "left_semi")
    texts_of = held.groupBy("word").agg(F.countDistinct("h").alias("texts"))
    stems = stems.join(texts_of.where(F.col("texts") >= least).select("word"), "word", "left_semi")
    seen = counts.where(F.col("word").isin(*TERMS)).withColumn("odds", odds(F.col("toxic"), F.col("other"), n_toxic, n_other))
    for r in seen.where((F.col("odds") < LEAST_ODDS) & (F.col("toxic") + F.col("other") >= LEAST_TEXTS)).collect():
        known.pop(r["word"])
    found, common = known | best(counts), best(stems.where(F.col("other") * 50 <= F.col("toxic")))
    plain, strict = ordinary(found, common, counts, n_toxic, n_other)
    return Model(found, common, plain=plain, strict=strict)


def ordinary(words: dict[str, float], stems: dict[str, float], counts: DataFrame, n_toxic: int, n_other: int) -> tuple[frozenset[str], frozenset[str]]:
    """Near misses that are ordinary words, as others than toxic texts hold them, and terms whose near misses speak for nothing."""
    tries: list[Misspellings] = []

    def run(column: pa.Array) -> pa.Array:
        if not tries:
            tries.append(Misspellings(words, stems))
        return pa.array([None if (found := tries[0].match(w)) is None or not found[1] else tries[0].miss(w)[1] for w in column.to_pylist()], pa.string())

    # Not to be repeated: as a deterministic function it would run again below the filter, in workers of its own.
    missed = F.arrow_udf(run, "string").asNondeterministic()
    near = written(counts.withColumn("term", missed("word")).where(F.col("term").isNotNull()), "near-misses")
    plain = frozenset(r["word"] for r in near.where(F.col("other") > 0).select("word").collect())
    terms = near.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).withColumn("odds", odds(F.col("toxic"), F.col("other"), n_toxic, n_other))
    learned = ~F.col("term").isin(*TERMS) & (F.col("other") > 0)
    against = terms.where((F.col("odds") < LEAST_ODDS) & (learned | (F.col("toxic") + F.col("other") >= LEAST_TEXTS)))
    return plain, frozenset(r["term"] for r in against.collect())


def regression(features: np.ndarray, labels: np.ndarray, rounds: int = 25, ridge: float = 1.0) -> tuple[float, ...]:
    """Coefficients of a logistic regression, bias first; evidence never speaks against toxicity."""
    x = np.column_stack([np.ones(len(features)), features])
    active = np.ones(x.shape[1], bool)
    while True:
        w = np.zeros(x.shape[1])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            penalty = ridge * np.eye(x.shape[1])
            penalty[0, 0] = 1e-3
            hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
            step = np.linalg.solve(hessian, x.T @ (labels - p) - penalty @ w)
            w = np.where(active, w + np.clip(step, -4, 4), 0.0)
        wrong = active & (w < 0) & (np.arange(len(w)) > 0)
        if not wrong.any():
            return tuple(float(v) for v in w)
        active &= ~wrong
        x = np.where(active[None, :], x, 0.0)


class ToxicityModel:
    """Fitted on labelled rows; scores any text.

    Of the labelled rows only those of `learn` (a condition over doc_id) are
    used, at most `most_rows` of them; four folds give the lexicon and another
    sets the regression, so that terms are weighed on texts they were not taken
    from. Null and empty texts have no hit and get the base score; repeated rows
    score alike; without usable labels the terms known beforehand count alone.
    """

    def __init__(self, docs: DataFrame, labels: DataFrame, learn: Column, most_rows: int = LABELLED_ROWS):
        spark = docs.sparkSession
        usable = labels.select(F.col("doc_id"), F.col("toxic").cast("int")).where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & learn)
        usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        n = usable.count()
        chosen = usable.sample(min(1.0, most_rows / max(n, 1)), seed=3).limit(most_rows)
        texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        rows = written(texts.join(F.broadcast(chosen), "doc_id"), "labelled")
        fold = F.pmod(F.xxhash64("text"), F.lit(4))
        self.model = lexicon(rows.where(fold != 0).select("text", "toxic"))
        held = self._features(rows.where(fold == 0)).collect()
        x, y = np.array([r["f"] for r in held], float), np.array([r["toxic"] for r in held], float)
        if min(y.sum(), len(y) - y.sum()) >= LEAST_FITTED:
            self.model.coefficients = regression(x, y)
        self.shared = spark.sparkContext.broadcast(self.model)

    def _features(self, rows: DataFrame) -> DataFrame:
        model, scorers = self.model, []

        def run(texts: pa.Array) -> pa.Array:
            if not scorers:
                scorers.append(Scorer(model))
            return mapped(scorers[0].features, texts, pa.list_(pa.float64()))

        return rows.select(F.arrow_udf(run, "array<double>")("text").alias("f"), "toxic")

    def score(self, text: Column) -> Column:
        """The score of a text, 0 to 1; higher means more likely toxic."""
        shared, scorers = self.shared, []

        def run(texts: pa.Array) -> pa.Array:
            if not scorers:
                scorers.append(Scorer(shared.value))
            return mapped(scorers[0].score, texts, pa.float64())

        return F.arrow_udf(run, "double")(text)


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))
