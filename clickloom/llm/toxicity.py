"""Toxicity by a learned lexicon, matched with Levenshtein automata, and the context of each match.

A bounded sample of labelled rows gives the lexicon: words that toxic documents have far more often than
others, and stems whose words do. The terms form a trie; its intersection with the Levenshtein automata of
the terms is determinised into one table, which reads all words of a batch side by side. A match is exact
or misspelled, and quoted or plain by the quotation marks in a window around it. A logistic model
over the counts of each term and of quoted and misspelled matches, fitted on the same sample, gives the score.

Results for odd input: null, empty or wordless text has no matches and the score of a text without any. Null
doc_id: scored, held_out is null. Repeated rows: scored each. Labels that are null or not 0 or 1 are not
learned; a document with both labels counts as toxic. No toxic row to learn from: every score is 0. Empty table: no rows.
Columns other than doc_id and text are kept and never
read; those named like results are replaced.
"""

from __future__ import annotations

import collections
import dataclasses
import re
import sys
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import sampled, small_batches, stored, unused

WORD = re.compile(r"[^\W_]+")
#: Fixed: marks that open or close a quotation.
QUOTES = "\"“”„‟«»「」『』"


@dataclasses.dataclass
class Model:
    alphabet: np.ndarray          # sorted code points; any other is class 0
    table: np.ndarray             # state x class -> state; 0 is dead, 1 the start
    edits: np.ndarray             # state -> edits of its match, -1 without one
    which: np.ndarray             # state -> the term that it matches
    final: np.ndarray             # state -> no later letter can change it
    clean: frozenset[str]         # misspelling-like words that the sample's clean rows use
    terms: int
    weights: np.ndarray
    window: int


def allowed(term: str) -> int:
    """Edits that a term of this length may have."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


def lexicon(toxic: list[str], clean: list[str], ratio: float, support: float, most: int) -> list[tuple[str, bool]]:
    """(term, whether any word that begins with it matches), the most frequent first."""
    seen, other = collections.Counter(), collections.Counter()
    whole = collections.Counter()
    for text in toxic:
        own = set(WORD.findall(text))
        whole.update(own)
        seen.update({w[:i] for w in own for i in range(3, min(len(w), 24) + 1)})
    for text in clean:
        other.update({w[:i] for w in set(WORD.findall(text)) for i in range(3, min(len(w), 24) + 1) if w[:i] in seen})
    least = max(4, support * len(toxic))
    good = {p for p, n in seen.items()
            if len(p) >= 4 and n >= least and (n + 0.5) / (len(toxic) + 1) >= ratio * (other[p] + 0.5) / (len(clean) + 1)}
    longer = collections.defaultdict(list)
    for p in good:
        longer[p[:-1]].append(p)
    terms = []
    for p in sorted(good):
        if p[:-1] in good:
            continue  # a shorter prefix is as telling
        n = seen[p]
        while same := [q for q in longer[p] if seen[q] == n]:
            p = same[0]
        terms.append((n, p, whole[p] < n))
    return [(p, stem) for _, p, stem in sorted(terms, key=lambda t: (-t[0], t[1]))[:most]]


def automaton(terms: list[tuple[str, bool]]) -> tuple[np.ndarray, ...]:
    """The trie of the terms intersected with their Levenshtein automata, as one deterministic table."""
    child: list[dict[str, int]] = [{}]
    limit, ends, stems, name = [0], [-1], [-1], [-1]
    for number, (term, stem) in enumerate(terms):
        k = allowed(term) if not stem or len(term) >= 6 else 0
        at = 0
        limit[0] = max(limit[0], k)
        for c in term:
            if c not in child[at]:
                child[at][c] = len(child)
                child.append({})
                for column in (limit, ends, stems, name):
                    column.append(-1 if column is not limit else 0)
            at = child[at][c]
            limit[at] = max(limit[at], k)
        (stems if stem else ends)[at], name[at] = k, number
    letters = sorted({c for term, _ in terms for c in term})

    def closed(nodes: dict[int, int]) -> dict[int, int]:
        todo = list(nodes.items())
        while todo:
            at, e = todo.pop()
            for to in child[at].values():
                if e + 1 <= limit[to] and e + 1 < nodes.get(to, 9):
                    nodes[to] = e + 1
                    todo.append((to, e + 1))
        return nodes

    nothing = (9, -1)

    def key(nodes: dict[int, int], best: tuple[int, int]):
        best = min([best, *((e, name[at]) for at, e in nodes.items() if e <= stems[at])])
        return (frozenset() if best[0] == 0 else frozenset(nodes.items())), best

    start = key(closed({0: 0}), nothing)
    states, rows, todo = {(frozenset(), nothing): 0, start: 1}, {}, [start]
    while todo:
        now = todo.pop()
        row = []
        for c in ["", *letters]:
            nodes: dict[int, int] = {}
            for at, e in now[0]:
                moves = [(to, e + (x != c)) for x, to in child[at].items()] + [(at, e + 1)]
                for to, edits in moves:
                    if edits <= limit[to] and edits < nodes.get(to, 9):
                        nodes[to] = edits
            to = key(closed(nodes), now[1])
            if to not in states:
                states[to] = len(states)
                todo.append(to)
            row.append(states[to])
        rows[states[now]] = row
    table = np.zeros((len(states), len(letters) + 1), np.int32)
    edits, which, final = np.full(len(states), -1), np.full(len(states), -1), np.zeros(len(states), bool)
    for s, row in rows.items():
        table[s] = row
    for (nodes, best), s in states.items():
        found = min([best, *((e, name[at]) for at, e in nodes if e <= ends[at])])
        if found != nothing:
            edits[s], which[s] = found
        final[s] = not nodes
    return np.array([ord(c) for c in letters], np.uint32), table, edits, which, final


_IS_WORD = None


def _word_table() -> np.ndarray:
    global _IS_WORD
    if _IS_WORD is None:
        _IS_WORD = np.fromiter((unicodedata.category(chr(i))[0] in "LN" for i in range(sys.maxunicode + 1)), bool)
    return _IS_WORD


def matches(model: Model, texts: list[str]):
    """(text, place, word, edits, term) of all words of some lower-cased texts that the automaton accepts."""
    joined = "\n".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points) or not len(model.alphabet):
        return
    word = _word_table()[points]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    begin, end = edge[0::2], edge[1::2]
    kind = np.searchsorted(model.alphabet, points).clip(0, len(model.alphabet) - 1)
    kind = np.where(model.alphabet[kind] == points, kind + 1, 0)
    alive, state, j = np.arange(len(begin)), np.ones(len(begin), np.int32), 0
    hits: list[tuple[np.ndarray, np.ndarray]] = []
    while len(alive):
        state = model.table[state, kind[begin[alive] + j]]
        j += 1
        over = (begin[alive] + j == end[alive]) | model.final[state]
        took = over & (model.edits[state] >= 0)
        hits.append((alive[took], model.edits[state[took]], model.which[state[took]]))
        alive, state = alive[~over], state[~over]
    at, edits, which = (np.concatenate(x).tolist() for x in zip(*hits, strict=True)) if hits else ((), (), ())
    ends = np.cumsum([len(t) + 1 for t in texts])
    for i, e, w in sorted(zip(at, edits, which, strict=True)):
        t = int(np.searchsorted(ends, begin[i], side="right"))
        yield t, int(begin[i] - ends[t]) + len(texts[t]) + 1, joined[begin[i]:end[i]], e, w


def quoted(text: str, place: int, size: int, window: int) -> bool:
    """Whether quotation marks stand on both sides, none of them closing before the match."""
    before = text[max(0, place - window):place]
    after = text[place + size:place + size + window]
    left = sum(before.count(q) for q in QUOTES)
    return left % 2 == 1 and any(q in after for q in QUOTES)


def counts(model: Model, texts: list[str]) -> np.ndarray:
    """Per text: exact matches of each term, then exact quoted, misspelled plain and misspelled quoted matches."""
    out = np.zeros((len(texts), model.terms + 3))
    for t, place, word, edits, which in matches(model, texts):
        if not edits or word not in model.clean:
            out[t, which if not edits else model.terms + 1] += 1
            if quoted(texts[t], place, len(word), model.window):
                out[t, model.terms + 2 * (edits > 0)] += 1
    return out


def scores(model: Model, found: np.ndarray) -> np.ndarray:
    if not len(model.weights):
        return np.zeros(len(found))
    x = np.column_stack([np.ones(len(found)), np.log1p(found)])
    return 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))


def learn(rows: list[tuple[str, int]], ratio: float = 8.0, support: float = 0.02, most: int = 200, window: int = 120) -> Model:
    """A model of (text, label) rows, labels 0 or 1."""
    rows = sorted({(text.lower(), label) for text, label in rows}, key=lambda r: zlib.crc32(r[0].encode("utf-8", "ignore")))
    toxic, clean = [t for t, y in rows if y == 1], [t for t, y in rows if y == 0]
    none = Model(np.zeros(0, np.uint32), np.zeros((1, 1), np.int32), np.full(1, -1), np.full(1, -1), np.ones(1, bool),
                 frozenset(), 0, np.zeros(0), window)
    if not toxic:
        return none
    terms = lexicon(toxic, clean, ratio, support, most)
    names = ("alphabet", "table", "edits", "which", "final")
    model = dataclasses.replace(none, terms=len(terms), **dict(zip(names, automaton(terms), strict=True)))

    def misspelled(texts: list[str]) -> frozenset[str]:
        return frozenset(w for i in range(0, len(texts), 200) for _, _, w, e, _ in matches(model, texts[i:i + 200]) if e)

    # Each half is counted with the other half's clean words, as later texts are with those of the sample.
    found, y = [], []
    for half in (0, 1):
        model.clean = misspelled(clean[1 - half::2])
        for texts, label in ((toxic[half::2], 1), (clean[half::2], 0)):
            found += [counts(model, texts[i:i + 200]) for i in range(0, len(texts), 200)]
            y += [label] * len(texts)
    model.clean = misspelled(clean)
    x, y = np.concatenate(found), np.array(y)
    x = np.column_stack([np.ones(len(x)), np.log1p(x)])
    penalty = np.diag([0.01, *[0.3] * (x.shape[1] - 1)])

    def fit(w: np.ndarray, prior: np.ndarray) -> np.ndarray:
        for _ in range(60):  # Newton steps of the penalised likelihood
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ (w - prior))
            w = w + np.clip(step, -3, 3)
            if np.abs(step).max() < 1e-8:
                break
        return w

    prior = np.zeros(x.shape[1])
    w = fit(prior, prior)
    if terms:
        # Where the sample says little of them, a misspelled match counts half as much as a term, a quotation takes a quarter off.
        usual = max(0.0, float(w[1:-3].mean()))
        prior[-3:] = -usual / 4, usual / 2, -usual / 8
        w = fit(w, prior)
    model.weights = w
    return model


def sample(docs: DataFrame, labels: DataFrame, per_class: int, most_bytes: int) -> list[tuple[str, int]]:
    """Labelled rows to learn from: of each class those with the smallest hashes, none that is held out."""
    labels = (labels.where("toxic in (0, 1) and crc32(cast(doc_id as string)) % 4 != 2")
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    ids = sampled(labels, ["doc_id", "toxic"], 2 * per_class, group="toxic").select(F.col("doc_id").alias("_id"), "toxic")
    rows = docs.select("doc_id", "text").where(F.octet_length("text") <= most_bytes)
    # At most 4 * per_class ids are broadcast. An id may stand for many rows, so these are cut to as many again.
    rows = stored(rows.join(F.broadcast(ids), rows.doc_id == F.col("_id")).select("doc_id", "text", "toxic"), "labelled")
    return [(r.text, r.toxic) for toxic, most in ((1, per_class), (0, 2 * per_class))
            for r in sampled(rows.where(F.col("toxic") == toxic), ["doc_id", "text"], most).collect()]


def score(docs: DataFrame, labels: DataFrame, per_class: int = 1500, most_bytes: int = 20_000) -> DataFrame:
    """The documents with held_out, score, n_exact, n_misspelled and n_quoted added.

    Learns from at most `per_class` toxic and twice as many other rows, of at most `most_bytes` bytes each.
    """
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(learn(sample(docs, labels, per_class, most_bytes)))

    @F.arrow_udf("struct<score: double, n_exact: long, n_misspelled: long, n_quoted: long>")
    def scored(column: pa.Array) -> pa.Array:
        texts, found, begin = [(t or "").lower() for t in column.to_pylist()], [], 0
        while begin < len(texts):  # about two million letters at a time
            end, size = begin, 0
            while end < len(texts) and size < 2_000_000:
                size += len(texts[end])
                end += 1
            found.append(counts(model.value, texts[begin:end]))
            begin = end
        f = np.concatenate(found) if found else np.zeros((0, model.value.terms + 3))
        n = f.astype(np.int64)
        exact, extra = n[:, :model.value.terms].sum(axis=1), n[:, model.value.terms:]
        return pa.StructArray.from_arrays(
            [pa.array(scores(model.value, f)), *map(pa.array, (exact, extra[:, 1], extra[:, 0] + extra[:, 2]))],
            ["score", "n_exact", "n_misspelled", "n_quoted"])

    added = ["held_out", "score", "n_exact", "n_misspelled", "n_quoted"]
    docs, found = docs.drop(*added), unused(docs, "_found")
    return (docs.withColumn(found, scored("text")).withColumn("held_out", F.expr("crc32(cast(doc_id as string)) % 4 = 2"))
            .select("*", f"{found}.*").drop(found))
