"""Toxicity by a weighted finite-state pattern grammar.

Five small transducers read the token classes of a clause: negation, reported speech and target each pass a symbol on with
their mark, insult and threat turn marked symbols into patterns. They are composed into one automaton. A pattern's weight
times its word's weight is summed over the clauses, up to MOST for each pattern, so that a negated or reported insult counts by
its own weight, and the sum gives the score through a logistic function. Quotes hold over the clauses of a paragraph, and a
colon after a verb of saying ends no clause.

Word weights start from a short public list; labelled rows add words and stems (written ``stem*``) and correct weights. Pattern weights are fitted to the
same rows around the starting values, so a pattern which no labelled row shows keeps its own. At most ``fit_rows`` labelled
rows are used, drawn by hash; every document is scored.

Defined results: null text scores as an empty one; the whole text is read, whatever its length; rows without label and labels
without document are not learned from; a label given twice counts as toxic if one of them is; rows that are the same score
alike; without any toxic or any clean label the starting weights hold. A null doc_id counts as held out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.store import arrow_rows, saved
from shelfcast.llm.text import column

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE = range(7)
CLASSES = 7
PLAIN, TARGETED, NEGATED, REPORTED = range(4)
PATTERNS = 8  # insult and threat, each plain, targeted, negated, reported
#: Starting weights of the patterns, per unit of word weight, and of a document without any.
START = np.array([4.0, 5.0, 0.3, 0.6, 0.8, 5.0, 0.2, 0.5])
START_BIAS = -3.0
#: Starting words.
INSULTS = """idiot idiots moron morons stupid dumb scum trash pathetic worthless disgusting loser losers clown clowns imbecile
imbeciles bastard bastards bitch whore slut asshole assholes retard retards vermin filth parasite parasites crétin abruti
connard salope ordure imbécile idiote dummkopf arschloch schlampe abschaum trottel estúpido imbécil basura escoria pendejo
cabrón"""
THREATS = "kill murder shoot stab strangle hurt destroy lynch hang tuer töten umbringen matar"
TARGETS = "you your yours u he she they them him her these those toi vous tu dich du sie euch tú usted ustedes vosotros"
NEGATIONS = "not no never isn't aren't wasn't don't doesn't didn't nobody nicht kein keine niemals pas jamais nunca jamás"
REPORTS = "said says called calls wrote writes claimed claims quoted quotes told reported alleged dit dijo sagte schrieb escribió"
WORDS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[\"«»“”]")
CLAUSES = re.compile(r"([.!?;:\n]+)")
MOST = 6.0  # that a pattern counts in a text
STEMS = (6, 5, 4)  # letters


class Transducer:
    """Reads (class, marks) symbols; ``step`` gives the next state and the symbol passed on."""

    def __init__(self, states: int, step):
        self.states, self.step = states, step


def _negation(scope: int = 3) -> Transducer:
    def step(state, symbol):
        kind, marks = symbol
        marks = marks | {NEGATED} if state else marks
        return (scope if kind == NEGATION else max(0, state - 1)), (kind, marks)

    return Transducer(scope + 1, step)


def _reported() -> Transducer:
    """After a verb of saying, to the end of the clause; and between quotes."""

    def step(state, symbol):
        kind, marks = symbol
        if kind == QUOTE:
            return state ^ 2, symbol
        return (state | 1 if kind == REPORT else state), (kind, marks | {REPORTED} if state else marks)

    return Transducer(4, step)


def _target(reach: int = 4) -> Transducer:
    """A target at most ``reach`` tokens before."""

    def step(state, symbol):
        kind, marks = symbol
        return (reach if kind == TARGET else max(0, state - 1)), (kind, marks | {TARGETED} if state else marks)

    return Transducer(reach + 1, step)


def _words_of(kind: int, base: int, reach: int = 3) -> Transducer:
    """Turns one kind of word into patterns; one that waits for a target gives the difference when the target follows.

    What other transducers have made of a symbol passes through, and any such word ends the waiting.
    """

    def step(state, symbol):
        if symbol[0] in ("emit", "turn"):
            return 0, symbol
        at, marks = symbol
        if at == kind:
            way = NEGATED if NEGATED in marks else REPORTED if REPORTED in marks else TARGETED if TARGETED in marks else PLAIN
            return (reach if way == PLAIN else 0), ("emit", base + way)
        if at in (INSULT, THREAT):
            return 0, symbol
        if at == TARGET and state:
            return 0, ("turn", base)
        return max(0, state - 1), symbol

    return Transducer(reach + 1, step)


def compose(parts: list[Transducer]) -> tuple[np.ndarray, np.ndarray, list[tuple[int, ...]]]:
    """One automaton: next state and output by (state, class), and the parts' states. Output: pattern, -1 none, 8 + base for a plain one turned targeted."""
    start = tuple(0 for _ in parts)
    index, todo, rows = {start: 0}, [start], []
    while todo:
        state = todo.pop(0)
        row = []
        for kind in range(CLASSES):
            symbol, after = (kind, frozenset()), []
            for part, at in zip(parts, state):
                to, symbol = part.step(at, symbol)
                after.append(to)
            after = tuple(after)
            if after not in index:
                index[after] = len(index)
                todo.append(after)
            out = symbol[1] if symbol[0] == "emit" else 8 + symbol[1] if symbol[0] == "turn" else -1
            row.append((index[after], out))
        rows.append(row)
    table = np.array(rows)
    return table[:, :, 0], table[:, :, 1], list(index)


_next, _output, _states = compose([_negation(), _reported(), _target(), _words_of(INSULT, 0), _words_of(THREAT, 4)])
NEXT, OUTPUT = _next.tolist(), _output.tolist()
SAID, QUOTED = ([bool(state[1] & bit) for state in _states] for bit in (1, 2))
IN_QUOTE = NEXT[0][QUOTE]


@dataclass
class Grammar:
    """What was learned: word to (class, weight), pattern weights, bias."""

    words: dict[str, tuple[int, float]]
    weights: np.ndarray
    bias: float

    def triggers(self) -> "Triggers":
        return Triggers([w for w, (kind, _) in self.words.items() if kind in (INSULT, THREAT)])


class Triggers:
    """Tells whether some tokens hold one of the words or begin with one of the stems."""

    def __init__(self, words: list[str]):
        self.whole = frozenset(w for w in words if w[-1] != "*")
        stems = [w[:-1] for w in words if w[-1] == "*"]
        self.stems = [(n, frozenset(s for s in stems if len(s) == n)) for n in sorted({len(s) for s in stems})]

    def isdisjoint(self, tokens) -> bool:
        tokens = set(tokens)
        return self.whole.isdisjoint(tokens) and all(stems.isdisjoint([t[:n] for t in tokens]) for n, stems in self.stems)


def looked_up(words: dict[str, tuple[int, float]], token: str) -> tuple[int, float]:
    """The token's class and weight, by the whole word or by its longest stem."""
    if token in words:
        return words[token]
    for n in STEMS:
        if len(token) >= n and (stem := token[:n] + "*") in words:
            return words[stem]
    return OTHER, 0.0


def starting_words() -> dict[str, tuple[int, float]]:
    words = {}
    for text, kind in ((REPORTS, REPORT), (NEGATIONS, NEGATION), (TARGETS, TARGET), (THREATS, THREAT), (INSULTS, INSULT)):
        words.update({w: (kind, 1.0) for w in text.split()})
    return words


def pattern_sums(text: str, words: dict[str, tuple[int, float]], triggers: Triggers) -> np.ndarray | None:
    """Summed word weights by pattern over all clauses; None if no clause matches."""
    lowered = text.lower().replace("’", "'")
    if triggers.isdisjoint(WORDS.findall(lowered)):  # no token reaches over the end of a clause
        return None
    sums, state, waiting = np.zeros(PATTERNS), 0, 0.0
    parts = CLAUSES.split(lowered)
    for clause, end in zip(parts[::2], [*parts[1::2], ""]):
        for token in WORDS.findall(clause):
            kind, weight = looked_up(words, token) if len(token) > 1 or token.isalpha() else (QUOTE, 0.0)
            out = OUTPUT[state][kind]
            state = NEXT[state][kind]
            if 0 <= out < 8:
                sums[out] += weight
                waiting = weight
            elif out >= 8:
                sums[out - 8] -= waiting
                sums[out - 8 + TARGETED] += waiting
        if not (end == ":" and SAID[state]):
            state, waiting = IN_QUOTE if QUOTED[state] and "\n" not in end else 0, 0.0
    return sums


def _features(sums: np.ndarray) -> np.ndarray:
    return np.minimum(sums, MOST)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def _lowest_hash(values: Column, seed: int) -> Column:
    return F.array_min(F.transform(values, lambda v: F.xxhash64(F.lit(seed), v)))


def _stems(words: Column, letters: int) -> Column:
    return F.transform(F.filter(words, lambda w: F.length(w) >= letters), lambda w: F.concat(F.substring(w, 1, letters), F.lit("*")))


def _learn_words(sample: DataFrame, most: int = 800) -> dict[str, tuple[int, float]]:
    """Words and stems by how much more of the toxic rows have them; copies of a text count once.

    Of equal ones the longer stem comes first. They are taken one after another; each must still tell apart rows that have none of those taken before.
    """
    run = F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}']+")
    rows = sample.select("toxic", run.alias("run")).select("toxic", "run", F.array_distinct("run").alias("words"))
    triples = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("run") - 3)), lambda i: F.slice("run", i + 1, 3))
    for seed in range(3):  # near copies share the lowest hash of their word triples most of the time
        rows = rows.withColumn("low", _lowest_hash(triples, seed)).dropDuplicates(["low", "toxic"]).drop("low")
    stems = F.flatten(F.array(*[_stems(F.col("words"), n) for n in STEMS]))
    rows = saved(rows.withColumn("words", F.array_distinct(F.concat("words", stems))).drop("run"), "toxic-words")
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    least = max(5, toxic // 200)
    words = starting_words()
    if not toxic or not clean:
        return words
    found = rows.select("toxic", F.explode("words").alias("word")).where(F.length("word") > 2).groupBy("word").agg(
        F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")
    )
    odds = (F.col("t") + 0.5) / (toxic - F.col("t") + 0.5) / ((F.col("c") + 0.5) / (clean - F.col("c") + 0.5))
    seeds = [w for w, (kind, _) in words.items() if kind in (INSULT, THREAT)]
    ranked = found.where(F.col("word").isin(seeds) | ((F.col("t") >= least) & (odds >= 20.0)))
    ranked = ranked.withColumn("gain", F.log(odds) * F.sqrt("t")).orderBy(F.desc("gain"), "word").limit(most).collect()
    by_word = {r["word"]: (r["t"], r["c"]) for r in ranked}
    hits = F.array_intersect("words", F.array(*[F.lit(w) for w in by_word] or [F.lit("")]))
    marked = rows.select("toxic", hits.alias("hits")).where(F.size("hits") > 0).collect()
    left = {w: [0, 0] for w in by_word}
    has: dict[str, list[int]] = {w: [] for w in by_word}
    for i, r in enumerate(marked):
        for w in r["hits"]:
            left[w][r["toxic"]] += 1
            has[w].append(i)
    gone = [False] * len(marked)

    def sure(t: int, c: int) -> float:
        """A low estimate of the log odds, so that few rows prove little."""
        odds = np.log((t + 0.5) / (toxic - t + 0.5)) - np.log((c + 0.5) / (clean - c + 0.5))
        return float(odds - 2.5 * np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5)))

    while left:
        best = max(left, key=lambda w: (round(sure(left[w][1], left[w][0]), 9), w[-1] != "*", len(w), w))
        if left[best][1] < least or sure(left[best][1], left[best][0]) < 2.5:
            break
        whole_t, whole_c = by_word[best]
        strength = np.log((whole_t + 0.5) / (toxic - whole_t + 0.5)) - np.log((whole_c + 0.5) / (clean - whole_c + 0.5))
        kind = words.get(best, (INSULT, 0.0))[0]
        words[best] = (kind if kind == THREAT else INSULT, float(np.clip(strength / 6.0, 0.3, 1.5)))
        for i in has[best]:
            if not gone[i]:
                gone[i] = True
                for w in marked[i]["hits"]:
                    if w in left:
                        left[w][marked[i]["toxic"]] -= 1
        del left[best]
    for w in seeds:  # a listed word that clean rows use as often as toxic ones
        t, c = by_word.get(w, (0, 0))
        if c >= 5 and c / clean > 0.5 * t / toxic:
            words.pop(w, None)
    return words


def _fit_weights(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression around the starting weights, by Newton steps."""
    start = np.append(START, START_BIAS)
    penalty = np.append(np.full(PATTERNS, 1.0), 0.01)
    x, w = np.hstack([x, np.ones((len(x), 1))]), start.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * (w - start))
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return np.maximum(w[:-1], 0.0), float(w[-1])


def _sums_frame(docs: DataFrame, words: dict, keep: str) -> DataFrame:
    """(keep, sums array<double>) for every row of (keep, text); zeros where no clause matches."""
    triggers = Grammar(words, START, START_BIAS).triggers()
    kind = docs.schema[keep].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = [0.0] * PATTERNS
        for batch in batches:
            found = [pattern_sums(t.as_py() or "", words, triggers) for t in column(batch, "text")]
            sums = pa.array([none if s is None else s.tolist() for s in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([column(batch, keep), sums], [keep, "sums"])

    return docs.select(keep, "text").mapInArrow(run, f"{keep} {kind}, sums array<double>")


def fit_grammar(docs: DataFrame, labels: DataFrame, *, fit_rows: int = 20_000) -> Grammar:
    """Learn words and weights from at most about ``fit_rows`` labelled rows outside the held-out fifth, drawn by hash."""
    arrow_rows(docs.sparkSession, 1000)
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    if n > fit_rows:
        known = known.where(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 20)) < int((1 << 20) * fit_rows / n))
    sample = saved(docs.select("doc_id", "text").join(known, "doc_id").dropDuplicates(["doc_id"]), "toxic-sample")
    words = _learn_words(sample)
    rows = _sums_frame(sample, words, "toxic").collect()
    if len({r["toxic"] for r in rows}) < 2:
        return Grammar(words, START, START_BIAS)
    weights, bias = _fit_weights(_features(np.array([r["sums"] for r in rows])), np.array([r["toxic"] for r in rows], float))
    return Grammar(words, weights, bias)


def score_toxicity(docs: DataFrame, grammar: Grammar, *, text: str = "text", to: str = "toxicity") -> DataFrame:
    """``docs`` with its toxicity, 0 to 1, in the column ``to``."""
    triggers, words, weights, bias = grammar.triggers(), grammar.words, grammar.weights, grammar.bias
    arrow_rows(docs.sparkSession, 1000)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        out = np.full(len(texts), bias)
        for i, t in enumerate(texts):
            sums = pattern_sums(t.as_py() or "", words, triggers)
            if sums is not None:
                out[i] += _features(sums) @ weights
        return pa.array(1 / (1 + np.exp(-np.clip(out, -30, 30))))

    return docs.withColumn(to, score(F.col(text)))
