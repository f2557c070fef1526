"""Missing or wrong document language labels (problem 8).

Cross-parsing entropy. For each language a suffix automaton of its labelled text knows every substring. A
piece of a post is parsed greedily into the longest phrases that stand in a language's text; the language
that needs the fewest phrases, each costing the logarithm of that text's length, describes it best. The
automata are dense tables, and all pieces of a batch are parsed side by side, letter by letter.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from readloom.llm.forum_text import running_text, sentences
from readloom.session import cut

#: Labelled rows of each language that are learnt from at most; the rest of a larger sample is not needed.
LEARN_ROWS = 1_000
#: Letters of each language that are learnt from at most: bounds the automata, which every task holds.
LEARN_LETTERS = 60_000
#: Labelled posts from which each language's text is enlarged (about so many, chosen by a hash), the letters added
#: at most in each round, and how sure their pieces must be.
ENLARGE_POSTS, ENLARGE_LETTERS, ENLARGE_CONFIDENCE = 2_000, 3_000, 0.9
#: Rounds of enlarging; each parses with what the ones before have added.
ENLARGE_ROUNDS = 4
#: What a change of language between neighbouring pieces costs, in phrases.
SWITCH = 2.5

#: Codes of two and three letters, English and own names of the languages.
LANGUAGE_NAMES = {
    "en": ("en", "eng", "english"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "fr": ("fr", "fra", "fre", "french", "français", "francais"),
    "es": ("es", "spa", "spanish", "español", "espanol", "castellano"),
    "pt": ("pt", "por", "portuguese", "português", "portugues"),
    "nl": ("nl", "nld", "dut", "dutch", "nederlands"),
    "sv": ("sv", "swe", "swedish", "svenska"),
    "pl": ("pl", "pol", "polish", "polski"),
    "ru": ("ru", "rus", "russian", "русский"),
    "zh": ("zh", "zho", "chi", "chinese", "中文", "汉语", "漢語"),
}


_DIGITS, _SIGNS = re.compile(r"\d+"), re.compile(r"[\W_]+")
_HAN = re.compile("[\u3400-\u9fff]")


_PLAIN = {i: chr(i) if chr(i).isalpha() else "0" if chr(i).isdigit() else " " for i in range(128)}


def folded(text: str) -> str:
    """Text as it is parsed: lower case, digits as one sign, other signs and blanks as single blanks."""
    text = text.lower()
    if text.isascii():
        text = " ".join(text.translate(_PLAIN).split())
        return _DIGITS.sub("0", text) if "00" in text else text
    return _SIGNS.sub(" ", _DIGITS.sub("0", unicodedata.normalize("NFC", text))).strip()


def automaton(text: str) -> list[dict[str, int]]:
    """The transitions of the suffix automaton of ``text``; state 0 is the start."""
    go: list[dict[str, int]] = [{}]
    link, size, last = [-1], [0], 0
    for c in text:
        now = len(go)
        go.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = now
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if size[p] + 1 == size[q]:
                link[now] = q
            else:
                copy = len(go)
                go.append(dict(go[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                link[q] = link[now] = copy
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = copy
                    p = link[p]
        last = now
    return go


_PARSERS: dict[int, "Parser"] = {}


class Parser:
    """The automata of all languages as dense tables over one alphabet."""

    def __init__(self, texts: dict[str, str]):
        self.langs = sorted(texts)
        self.letter = {c: i + 1 for i, c in enumerate(sorted({c for t in texts.values() for c in t}))}  # 0: in no language
        self.by_point = np.zeros(max(map(ord, self.letter), default=0) + 1, np.int32)
        for c, i in self.letter.items():
            self.by_point[ord(c)] = i
        self.columns, self.steps, self.widths, self.cost = [], [], [], []
        for lang in self.langs:
            go = automaton(texts[lang])
            own = {c: i + 1 for i, c in enumerate(sorted(set(texts[lang])))}
            column = np.zeros(len(self.letter) + 1, np.int32)
            for c, i in own.items():
                column[self.letter[c]] = i
            # a step is the next state times two, plus one where a phrase ends before the letter; the last state
            # follows a letter that the language lacks, which is a phrase of its own
            lacks = len(go)
            start = np.full(len(own) + 1, 2 * lacks + 1, np.int32)
            for c, s in go[0].items():
                start[own[c]] = 2 * s + 1
            step = np.tile(start, (lacks + 1, 1))
            step[0] = 2 * lacks
            for s, to in enumerate(go):
                for c, t in to.items():
                    step[s, own[c]] = 2 * t
            self.columns.append(column)
            self.steps.append(step.ravel())
            self.widths.append(len(own) + 1)
            self.cost.append(math.log(max(2, len(texts[lang]))))
        self.phrase = float(np.mean(self.cost)) if self.cost else 1.0

    @classmethod
    def of(cls, texts: dict[str, str]) -> Parser:
        """The parser of these texts, made once in a worker process."""
        key = hash(tuple(sorted(texts.items())))
        if key not in _PARSERS:
            _PARSERS.clear()
            _PARSERS[key] = cls(texts)
        return _PARSERS[key]

    def costs(self, pieces: list[str]) -> np.ndarray:
        """For each piece and language: phrases times the cost of one."""
        out = np.zeros((len(pieces), len(self.langs)))
        if not pieces:
            return out
        order = sorted(range(len(pieces)), key=lambda i: -len(pieces[i]))
        size = np.array([len(pieces[i]) for i in order])
        points = np.frombuffer("".join([pieces[i] for i in order]).encode("utf-32-le", "surrogatepass"), np.uint32)
        flat = np.where(points < len(self.by_point), self.by_point[np.minimum(points, len(self.by_point) - 1)], 0)
        begin = np.cumsum(size) - size
        alive = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
        # the letters by place, then by piece: one stretch for each step
        place = np.arange(len(flat)) - np.repeat(begin, size)
        by_place = np.argsort(place, kind="stable")
        for k, (column, step, width, cost) in enumerate(zip(self.columns, self.steps, self.widths, self.cost)):
            letters = column[flat][by_place]
            state = np.zeros(len(order), np.int32)
            phrases = np.zeros(len(order), np.int32)
            done = 0
            for n in alive.tolist():
                now = state[:n]
                now *= width
                now += letters[done : done + n]
                got = step[now]
                done += n
                phrases[:n] += got & 1
                np.right_shift(got, 1, out=now)
            out[order, k] = (phrases + (size > 0)) * cost
        return out


def _confidence(costs: np.ndarray, phrase: float) -> np.ndarray:
    """The share of each language in the odds that the costs give."""
    odds = np.exp(-(costs - costs.min(axis=-1, keepdims=True)) / phrase)
    return odds / odds.sum(axis=-1, keepdims=True)


def _long_pieces(least: int):
    def long(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(lang, p[1]) for lang, t in zip(batch["lang"], batch["text"]) for p in _pieces(t) if p[2] >= least]
            yield pd.DataFrame(rows, columns=["lang", "piece"])

    return long


def _own_pieces(texts: dict[str, str], confidence: float):
    """Pieces that the parser also gives to the language of their post's label, with the letters a phrase covers."""

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parser = Parser.of(texts)
        for batch in batches:
            costs = parser.costs(batch["piece"].tolist())
            best = costs.argmin(axis=1)
            sure = _confidence(costs, parser.phrase).max(axis=1) if len(batch) else np.zeros(0)
            good = (np.array(parser.langs, object)[best] == batch["lang"].to_numpy()) & (sure >= confidence)
            news = costs[np.arange(len(batch)), best] / (batch["piece"].str.len().to_numpy() + 10)
            yield pd.DataFrame({"lang": batch["lang"][good], "piece": batch["piece"][good], "news": news[good]})

    return own


def learn(samples: DataFrame, docs: DataFrame | None = None, *, rows: int = LEARN_ROWS, letters: int = LEARN_LETTERS, posts: int = ENLARGE_POSTS, more: int = ENLARGE_LETTERS, confidence: float = ENLARGE_CONFIDENCE, rounds: int = ENLARGE_ROUNDS) -> dict[str, str]:
    """Each language's text: its labelled rows in the order of sample_id, at most ``rows`` and ``letters`` of them, and of
    ``docs`` the pieces that say most new.

    For the last, about ``posts`` posts are taken of each language that a label names alone (chosen by a
    hash of doc_id). Their pieces that label and parser together give to that language, at least as surely as
    ``confidence``, are ordered by how little of them is known, and ``more`` letters of them are added; so again in
    ``rounds`` rounds. All bounds are parameters; only the fit is bounded, every post is classified. Rows without a
    language or text are not used.
    """
    ok = samples.where("lang is not null and length(trim(text)) > 0").select(F.lower(F.trim("lang")).alias("lang"), "sample_id", "text")
    # Spark drops rows beyond the bound before it shuffles, so no language's rows are ever in one task
    first = ok.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("sample_id", "text"))).where(F.col("n") <= rows)
    texts: dict[str, str] = {}
    for r in first.orderBy("lang", "n").collect():  # at most ``rows`` rows a language
        texts[r["lang"]] = f"{texts.get(r['lang'], '')} {folded(r['text'])}".strip()[:letters]
    if docs is None or not texts:
        return texts
    named = docs.where("doc_id is not null and text is not null").select("doc_id", "text", label_languages(F.col("lang")).alias("named")).where("size(named) = 1").select("doc_id", "text", F.get("named", F.lit(0)).alias("lang"))
    named = named.where(F.col("lang").isin(*texts))
    counts = {r[0]: r[1] for r in named.groupBy("lang").count().collect()}  # one row a language
    if not counts:
        return texts
    share = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, posts / n))))
    chosen = named.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / float(1 << 53) < share[F.col("lang")])
    pieces = cut(chosen.select("lang", "text").mapInPandas(_long_pieces(30), "lang string, piece string").distinct())
    for _ in range(rounds):
        own = pieces.mapInPandas(_own_pieces(texts, confidence), "lang string, piece string, news double")
        order = Window.partitionBy("lang").orderBy(F.desc("news"), "piece").rowsBetween(Window.unboundedPreceding, -1)
        best = own.withColumn("before", F.coalesce(F.sum(F.length("piece")).over(order), F.lit(0))).where(F.col("before") < more)
        texts = dict(texts)
        for r in best.orderBy("lang", F.desc("news"), "piece").collect():  # at most ``more`` letters and one piece a language
            texts[r["lang"]] += " " + r["piece"]
    return texts


def _pieces(text: str | None) -> list[tuple[str, str, int, int]]:
    """(piece, folded, letters, Han letters) of a post's running text."""
    out = []
    for s in sentences(running_text(text)):
        n = sum(map(str.isalpha, s))
        if n:
            out.append((s, folded(s), n, 0 if s.isascii() else len(_HAN.findall(s))))
    return out


def _best_path(costs: np.ndarray, switch: float) -> np.ndarray:
    """The language of each piece, with the least total cost of pieces and changes."""
    n, k = costs.shape
    back = np.zeros((n, k), np.int64)
    total = costs[0].copy()
    for i in range(1, n):
        j = int(total.argmin())
        change = total[j] + switch
        back[i] = np.where(total <= change, np.arange(k), j)
        total = np.minimum(total, change) + costs[i]
    path = np.zeros(n, np.int64)
    path[-1] = int(total.argmin())
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def _segments(texts: dict[str, str], switch: float):
    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parser = Parser.of(texts)
        for batch in batches:
            pieces = [_pieces(t) for t in batch["text"]]
            costs = parser.costs([p[1] for ps in pieces for p in ps])
            rows, at = [], 0
            for doc_id, ps in zip(batch["doc_id"], pieces):
                if not ps or not parser.langs:
                    continue
                c = costs[at : at + len(ps)]
                at += len(ps)
                path = _best_path(c, switch * parser.phrase)
                cuts = [0, *(np.flatnonzero(path[1:] != path[:-1]) + 1).tolist(), len(ps)]
                for number, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    lang = parser.langs[path[a]]
                    confidence = float(_confidence(c[a:b].sum(axis=0), parser.phrase)[path[a]])
                    rows.append((doc_id, number, lang, confidence, sum(p[2] for p in ps[a:b]), sum(p[3] for p in ps[a:b]), " ".join(p[0] for p in ps[a:b])))
            yield pd.DataFrame(rows, columns=["doc_id", "segment", "lang", "confidence", "letters", "han", "text"])

    return segments


def language_segments(docs: DataFrame, samples: DataFrame, *, switch: float = SWITCH) -> DataFrame:
    """``(doc_id, segment, lang, confidence, letters, han, text)``: each post's running text in segments of one language.

    Segments are runs of sentences; a change of language must save more than ``switch`` phrases.
    confidence is the language's share of the odds that the phrase counts give. Posts without letters
    (null, empty, deleted) have no segment. Whole texts are parsed; an empty table or sample gives no rows.
    """
    schema = "doc_id bigint, segment int, lang string, confidence double, letters bigint, han bigint, text string"
    texts = learn(samples, docs)
    return docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInPandas(_segments(texts, switch), schema)


def label_languages(label):
    """The languages that a label names, as an array of two-letter codes."""
    names = {name: code for code, all_names in LANGUAGE_NAMES.items() for name in all_names}
    table = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))
    parts = F.split(F.lower(F.coalesce(label, F.lit(""))), r"[,;/|+&]|\s+-\s+|\s+and\s+")
    first = F.transform(parts, lambda p: F.regexp_replace(F.regexp_replace(F.trim(p), r"\s*\(.*\)$", ""), r"^([a-z]{2,3})[-_@.].*$", "$1"))
    return F.array_distinct(F.array_compact(F.transform(first, lambda p: F.try_element_at(table, p))))


def document_languages(docs: DataFrame, samples: DataFrame, *, letters: int = 40, han: int = 20) -> DataFrame:
    """``(doc_id, lang, confidence, letters, labelled)``: the languages of each post with enough running text.

    Enough is ``letters`` letters, of zh ``han`` Han letters, over all segments in that language.
    confidence is the segments' mean by letters; labelled, whether the post's label names the language.
    """
    found = language_segments(docs, samples).groupBy("doc_id", "lang").agg(F.sum("letters").alias("letters"), F.sum("han").alias("han"), (F.sum(F.col("confidence") * F.col("letters")) / F.sum("letters")).alias("confidence"))
    enough = found.where(F.when(F.col("lang") == "zh", F.col("han") >= han).otherwise(F.col("letters") >= letters))
    labels = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), label_languages(F.col("lang")).alias("named"))
    return enough.join(labels, "doc_id").select("doc_id", "lang", "confidence", "letters", F.array_contains("named", F.col("lang")).alias("labelled"))
