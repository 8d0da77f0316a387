"""Problem 3: noise in text from scanned pages.

Lines are labelled as furniture (running headers and footers, page numbers),
body, broken (body whose last word goes on in the next line) or blank by a
hidden Markov model over layout features. It starts from lines that the
document's title, the page number and the corpus's words label without doubt,
and is fitted by rounds of labelling and counting, over all pages whose
documents have a title; only the sums of counts meet.

Words are held against the words of pages that have a text layer. What
recognition misreads is learned by aligning all words that these don't know with
those that differ in one place: a confusion is what many words bear out in one
direction and hardly any in the other. A word that isn't known, but is with a
confusion or two put right, is misread, if the page's confidence makes that
likelier than a new word. Paragraphs are put together again from the labels.

Pages are handled in blocks: a block asks for its distinct words once, and the
answers come back by block, so that neither the corpus's vocabulary nor the
table of misread words is ever in one place.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_hot
from ..plans.tables import once
from ..session import materialize, spread

#: Pages of a block, and their characters, at most about.
BLOCK_PAGES, BLOCK_CHARS = 400, 1_000_000
#: Letters of the longest word that is looked up; longer stretches are no words.
MAX_WORD = 40
#: A word is known if it stands in so many places of pages with a text layer.
KNOWN = 2

#: Letters of a word that confusions are learned from, at least, and words that must bear one out, so many times as often as its reverse.
LEARNT_WORD, SUPPORT, ONE_WAY = 6, 4, 4
#: Part of the words that aren't known that must bear a confusion out besides: by chance, more words agree in a larger corpus.
SUPPORT_SHARE = 2e-5
#: Rows that the spellings of words are handed on in, about.
VARIANT_ROWS = 100_000
#: Letters from which a word may have two confusions.
TWICE = 9

# What recognition usually makes (left) of what was printed (right). Others are learned from the corpus.
MISREAD = (
    ("rn", "m"), ("vv", "w"), ("ii", "ü"), ("cl", "d"), ("li", "h"), ("d", "cl"), ("h", "li"), ("m", "rn"), ("w", "vv"), ("nn", "m"), ("in", "m"), ("ri", "n"),
    ("c", "e"), ("e", "c"), ("b", "h"), ("h", "b"), ("l", "i"), ("i", "l"), ("l", "t"), ("f", "t"), ("t", "f"), ("u", "ü"), ("o", "ö"), ("a", "ä"), ("u", "n"), ("n", "u"), ("q", "g"), ("g", "q"), ("v", "y"), ("o", "c"), ("o", "e"), ("a", "o"),
)
# Digits among letters, and letters among digits.
DIGIT_AS_LETTER = {"0": "o", "1": "li", "3": "e", "4": "a", "5": "s", "6": "b", "8": "b", "9": "g", "2": "z"}
LETTER_AS_DIGIT = str.maketrans("OoDQIlTZzSsBbGgq", "0000117225586699")

HYPHENS = "-‐‑¬­"
_WORD = re.compile(r"[^\W\d_]+")
_COMPOUND = re.compile(r"(?<![^\W_])[^\W\d_]++(?:-[^\W\d_]++)+")
_WITH_DIGIT = re.compile(r"(?<!\S)[^\s\d]*+\d\S*")
_LETTER = re.compile(r"[^\W\d_]")
_USUAL_CODE = re.compile(r"[A-Z]+-\d+")
_HEAD = re.compile(r"^[ \t]*([^\W\d_]+)")
_LEAD, _TRAIL = "([{\"'«»|*•·-–—.,;:!?؟،", "([{\"'«»|*•·-–—.,;:!?؟،)]}%…"
_KEY = re.compile(r"[\W_]+")
_NUMBER = re.compile(r"\d+")
# a number or two, bare or with a word such as "page"
_PAGE = re.compile(r"^\W*(?:[^\W\d_]+\W+)?\d{1,9}(?:[ \t]*[/|–—-]?[ \t]*(?:[^\W\d_]+[ \t]+)?\d{1,9})?\W*$")
# a name that ends in its code or is cut off, perhaps with the page's number before or after
_NAMED = re.compile(r"^\W*(?:\d+\W+)?(?:[^\W\d_][\w'’]*[ \t]+){1,6}[^\W\d_]{1,3}-(?:\w{4,}|\w{2,}(?:\.{3}|…))(?:\W+\d+){0,2}\W*$")
_FIGURES = re.compile(r"\d[\d.,٠-٩]{3,}")


def shape(token: str) -> str:
    """Runs of letters as A or a, of digits as 9, other signs as they are."""
    if _USUAL_CODE.fullmatch(token):
        return "A-9"
    out = []
    for c in token:
        k = "9" if c.isdigit() else ("A" if c.isupper() else "a") if c.isalpha() else c
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out)


def mixed_tokens(line: str):
    """(start, token) of each token that holds digits and letters, without signs at its edges."""
    for m in _WITH_DIGIT.finditer(line):
        token = m[0]
        if not _LETTER.search(token):
            continue
        bare = token.lstrip(_LEAD)
        lead, bare = len(token) - len(bare), bare.rstrip(_TRAIL)
        if _LETTER.search(bare) and any(c.isdigit() for c in bare):
            yield m.start() + lead, bare


def vocabulary(pages: DataFrame) -> DataFrame:
    """(key, n): words in lower case, compounds with their hyphens, and shapes of mixed tokens (after a NUL), as often as they stand in pages with a text layer."""

    def count(frames):
        for f in frames:
            n: Counter = Counter()
            for t in f["text_content"]:
                low = t.lower()
                n.update(_WORD.findall(low))
                n.update(_COMPOUND.findall(low))
                n.update("\0" + shape(x) for _, x in mixed_tokens(t))
            short = [k for k in n if len(k) <= 2 * MAX_WORD]
            yield pd.DataFrame({"key": short, "n": [n[k] for k in short]})

    own = pages.where("extraction_method = 'text_layer' AND text_content IS NOT NULL").select("text_content")
    return own.mapInPandas(count, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))


def joints(lines: list[str]):
    """(line, left, right) of each line that ends in a letter and a hyphen before a line that starts with a letter."""
    for i, (a, b) in enumerate(zip(lines, lines[1:], strict=False)):
        a = a.rstrip(" \t\r")
        if not a or a[-1] not in HYPHENS or not (n := _HEAD.match(b)):
            continue
        k = len(a) - 1
        while k and a[k - 1].isalpha():
            k -= 1
        if k < len(a) - 1:
            yield i, a[k:-1], n[1]


def _blocks(frames):
    part, number = TaskContext.get().partitionId(), 0
    for f in frames:
        sizes = np.cumsum(f["text_content"].str.len().to_numpy())
        at = np.maximum(np.arange(len(f)) // BLOCK_PAGES, sizes // BLOCK_CHARS)
        for _, g in f.groupby(at):
            words, breaks, halves = set(), set(), set()
            for t in g["text_content"]:
                words.update(_WORD.findall(t.lower()))
                words.update("\0" + shape(x) for _, x in mixed_tokens(t))
                for _, left, right in joints(t.split("\n")):
                    breaks.update(((left + right).lower(), f"{left}-{right}".lower()))
                    halves.update((left.lower(), right.lower()))
            number += 1
            yield pd.DataFrame({"block": [(part << 33) + number], "ids": [g["id"].to_numpy()], "documents": [g["document_id"].to_numpy()], "numbers": [g["page_number"].to_numpy()], "confidences": [g["confidence"].to_numpy(dtype=float)], "texts": [g["text_content"].to_list()], "words": [sorted(w for w in words if len(w) <= MAX_WORD)], "breaks": [sorted(w for w in breaks if len(w) <= 2 * MAX_WORD)], "halves": [sorted(halves)]})


def holes(word: str):
    """(form, filling): the word with one or two letters left out, wherever they are."""
    for n in (1, 2):
        for i in range(len(word) - n + 1):
            yield f"{word[:i]}\0{word[i + n :]}", word[i : i + n]


def confusions(unknown: DataFrame, known: DataFrame) -> dict[str, list[str]]:
    """What is misread, as read: what may have been printed, from (key) and (key, n).

    All words with a single known word that differs in one place are aligned
    with it; each counts once, however often it stands. A confusion needs
    SUPPORT words, and SUPPORT_SHARE of all that were held against the known
    ones, so there are at most 1 / SUPPORT_SHARE of them in a corpus of any
    size. Usual confusions need no bearing out. The result is a parameter of
    the model.
    """

    def forms(frames):
        for f in frames:
            rows = [(form, w, x) for w in f["key"] if w.isalpha() and len(w) >= LEARNT_WORD - 1 for form, x in holes(w) if len(form) >= LEARNT_WORD]
            yield pd.DataFrame(rows, columns=["form", "word", "filling"])

    long = unknown.select("key").where(F.length("key") >= LEARNT_WORD)
    least = max(SUPPORT, SUPPORT_SHARE * long.count())
    schema = "form string, word string, filling string"
    asked = long.mapInPandas(forms, schema).select("form", F.col("word").alias("read"), F.col("filling").alias("a"))
    there = known.select("key").mapInPandas(forms, schema).select("form", F.col("word").alias("meant"), F.col("filling").alias("b"))
    # the least difference: nothing in common at either end
    apart = (F.substring("a", 1, 1) != F.substring("b", 1, 1)) & (F.substring("a", -1, 1) != F.substring("b", -1, 1))
    pairs = asked.join(there, "form").where(apart).groupBy("read").agg(F.count_distinct("meant").alias("n"), F.first("a").alias("a"), F.first("b").alias("b")).where("n = 1")
    counts = materialize(pairs.groupBy("a", "b").agg(F.count("*").alias("n")), "confusions")
    reverse = counts.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("n").alias("back"))
    borne = counts.where(F.col("n") >= least).join(reverse, ["a", "b"], "left").where(F.col("n") >= ONE_WAY * F.coalesce("back", F.lit(0))).collect()
    out: dict[str, list[str]] = {}
    for a, b in [*MISREAD, *sorted((r["a"], r["b"]) for r in borne)]:
        if b not in out.setdefault(a, []):
            out[a].append(b)
    return out


def variants(word: str, learnt: dict[str, list[str]]) -> dict[str, int]:
    """The word with one confusion put right, and, where it is long enough, with two; how many."""

    def once_(w: str) -> set[str]:
        return {w[:i] + right + w[i + n :] for n in (1, 2) for i in range(len(w) - n + 1) for right in learnt.get(w[i : i + n], ())}

    one = once_(word)
    two = set().union(*map(once_, one)) - one - {word} if len(word) >= TWICE else set()
    return dict.fromkeys(two, 2) | dict.fromkeys(one, 1)


def answers(blocks: DataFrame, words: DataFrame) -> tuple[DataFrame, float]:
    """(block, answers): for a word that isn't known its correction, or none; for joined words and compounds how often they stand.

    And the part of the words of pages with a text layer that aren't known
    there, but would be with a confusion put right: these are new, not misread.
    """
    wanted = blocks.select("block", F.explode("words").alias("key"))
    known = words.where(F.col("n") >= KNOWN).select("key", "n")
    unknown = materialize(wanted.join(known, "key", "left_anti"), "unknown")
    parts = blocks.select("block", F.explode("breaks").alias("key"))
    # an unknown joined word may be misread as well
    part = materialize(parts.where(~F.col("key").contains("-") & (F.length("key") <= MAX_WORD)).join(known, "key", "left_anti"), "parts")
    distinct = materialize(unknown.where(~F.col("key").startswith("\0")).select("key").distinct(), "distinct")
    # the two parts of a cut word are no words
    torn = blocks.select(F.explode("halves").alias("key")).distinct()
    learnt = blocks.sparkSession.sparkContext.broadcast(confusions(materialize(distinct.join(torn, "key", "left_anti"), "whole"), known))

    def put_right(frames):
        for f in frames:
            rows: list[tuple] = []
            for w in f["key"]:
                rows += [(w, v, n) for v, n in variants(w, learnt.value).items()]
                if len(rows) >= VARIANT_ROWS:
                    yield pd.DataFrame(rows, columns=["word", "key", "steps"])
                    rows = []
            yield pd.DataFrame(rows, columns=["word", "key", "steps"])

    best = F.struct(-F.col("steps"), "n", "key")
    corrected = lambda df: df.mapInPandas(put_right, "word string, key string, steps int").join(known, "key").groupBy("word").agg(F.max_by("key", best).alias("fix"), F.max_by("n", best).alias("n"))
    fixes = corrected(distinct).drop("n")
    odd = unknown.join(fixes, unknown["key"] == fixes["word"], "left").select("block", "key", "fix", F.lit(0).cast("long").alias("n"))
    joined = parts.join(words, "key").select("block", F.concat(F.lit("\1"), "key").alias("key"), F.lit(None).cast("string").alias("fix"), "n")
    near = corrected(part.select("key").distinct())
    cut = part.join(near, part["key"] == near["word"]).select("block", F.concat(F.lit("\2"), part["key"]).alias("key"), "fix", "n")
    plain = words.where(~F.col("key").startswith("\0") & ~F.col("key").contains("-"))
    new = corrected(plain.where(F.col("n") < KNOWN).select("key")).select(F.col("word").alias("key"))
    clean_rate = (plain.join(new, "key", "left_semi").agg(F.sum("n")).first()[0] or 0) / max(1, plain.agg(F.sum("n")).first()[0] or 0)
    asked = odd.unionByName(joined).unionByName(cut).groupBy("block").agg(F.collect_list(F.struct("key", "fix", "n")).alias("answers"))
    return asked, clean_rate


def titles(blocks: DataFrame, documents: DataFrame) -> DataFrame:
    """(block, titles): the titles of the documents of a block's pages, by document."""
    own = documents.select("id", "document_title").where("document_title IS NOT NULL")
    by_document = once(own).select(F.col("id").alias("document_id"), "document_title")
    wanted = blocks.select("block", F.explode(F.array_distinct("documents")).alias("document_id"))
    return join_hot(wanted, by_document, "document_id", "inner").groupBy("block").agg(F.collect_list(F.struct("document_id", "document_title")).alias("titles"))


# ---- layout features and the model

STATES = ("furniture", "body", "broken", "blank")
FURNITURE, BODY, BROKEN, BLANK = range(4)
#: Characters from which a line is running text: neither a name, a number nor a row of figures.
LONG = 90
#: Values of each feature: place, form, page number, title, hyphen, blank neighbours.
FEATURES = (5, 6, 3, 4, 4, 4)


#: Rounds of labelling and counting; tenths of confidence, and words that say how noisy one is.
FIT_ROUNDS, TENTHS, RATE_WORDS = 2, 10, 1000


def tenth(confidence: float) -> int:
    """The tenth of a confidence; the last value where there is none from 0 to 1."""
    return min(int(confidence * TENTHS), TENTHS - 1) if 0 <= confidence <= 1 else TENTHS


def _key(line: str) -> str:
    return _KEY.sub("", line).lower()


def features(lines: list[str], number: int, title: str | None, known: dict[str, int]) -> np.ndarray:
    """A row of feature values for each line; -1 throughout for a blank one."""
    out = np.full((len(lines), len(FEATURES)), -1, np.int64)
    filled = [i for i, x in enumerate(lines) if x.strip()]
    name = _key(title) if title else ""
    hyphen = {}
    for i, left, right in joints(lines):
        whole, compound = known.get("\1" + (left + right).lower(), 0), known.get(f"\1{left}-{right}".lower(), 0)
        torn = known.get("\2" + (left + right).lower(), 0)
        hyphen[i] = 1 if whole > compound or (torn and not compound) else 2 if compound else 3
    for place, i in enumerate(filled):
        line, back = lines[i].strip(), len(filled) - 1 - place
        where = 0 if place == 0 else 4 if back == 0 else 1 if place == 1 else 3 if back == 1 else 2
        apart = 2 * (i == 0 or not lines[i - 1].strip()) + (i == len(lines) - 1 or not lines[i + 1].strip())
        if len(line) >= LONG and len(line) > 2 * len(name):
            out[i] = (where, 5, 0, 0 if name else 3, hyphen.get(i, 0), apart)
            continue
        numbers = [int(x) for x in _NUMBER.findall(line) if len(x) < 10]
        key = _key(line)
        words = len(_WORD.findall(line))
        if len(line) < 40 and _PAGE.match(line) and not re.search(r"\d[.,]\d|%", line):
            form = 0
        elif len(line) < LONG and _NAMED.match(line) and (line.endswith(("...", "…")) or line[-1] not in ".!?؟,"):
            form = 1
        elif len(_FIGURES.findall(line)) >= 2 and words <= 6:
            form = 2  # a row of figures
        elif len(line) < 30:
            form = 3
        elif len(line) < 60:
            form = 4
        else:
            form = 5
        page = 2 if numbers and numbers[0] == number or numbers[-1:] == [number] else 1 if numbers else 0
        if not name:
            match = 3
        else:
            bare = key.removeprefix(str(number)) if not name.startswith(str(number)) else key
            match = 2 if key and (name in key and len(key) <= len(name) + 14) else 1 if len(bare) >= 6 and line.endswith(("...", "…")) and name.startswith(bare) else 0
        out[i] = (where, form, page, match, hyphen.get(i, 0), apart)
    return out


def sure_states(f: np.ndarray) -> np.ndarray:
    """What title, page number and known words say of the lines of a page."""
    out = np.where(f[:, 4] == 1, BROKEN, BODY)
    out[(f[:, 3] == 1) | (f[:, 3] == 2) | ((f[:, 1] == 0) & (f[:, 2] == 2))] = FURNITURE
    out[f[:, 1] < 0] = BLANK
    return out


#: Counts that ``tally`` makes: first states, steps between states, and values of each feature by state.
TALLY = (4, 16, *(3 * n for n in FEATURES))


def tally(pages: list[np.ndarray], labels: list[np.ndarray]) -> np.ndarray:
    """All that the model needs of labelled pages, as one row of counts, so that rows of different pages add up."""
    if not any(map(len, pages)):
        return np.zeros(sum(TALLY), np.int64)
    f, s = np.concatenate(pages), np.concatenate(labels)
    sizes = np.array([len(x) for x in pages if len(x)])
    first = np.cumsum(sizes) - sizes
    within = np.ones(len(s), bool)
    within[first] = False
    filled = s != BLANK
    step = np.bincount(4 * s[np.flatnonzero(within) - 1] + s[within], minlength=16)
    emit = [np.bincount(n * s[filled] + f[filled, k], minlength=3 * n) for k, n in enumerate(FEATURES)]
    return np.concatenate([np.bincount(s[first], minlength=4), step, *emit])


class LineModel:
    """A hidden Markov model with an emission for each feature, from the counts of labelled pages."""

    def __init__(self, counts: np.ndarray):
        start, step, *emit = np.split(0.5 + counts, np.cumsum(TALLY)[:-1])
        step, emit = step.reshape(4, 4), [e.reshape(3, -1) for e in emit]
        # a line of running text is no furniture, however it stands
        emit[1][FURNITURE, 5] = 1e-6
        # documents without a title: the value tells nothing
        emit[3][:, 3] = emit[3][:, :3].sum(1)
        self.start, self.step = np.log(start / start.sum()), np.log(step / step.sum(1, keepdims=True))
        self.emit = [np.log(e / e.sum(1, keepdims=True)) for e in emit]
        self.clean_rate, self.rates = 0.0, np.ones(TENTHS + 1)

    def trust(self, clean_rate: float, counts: np.ndarray) -> None:
        """``counts`` are (tenth of confidence, words and odd words that have a correction), the last of pages without a confidence."""
        self.clean_rate, n = clean_rate, counts[:, 0]
        # a tenth of few words is taken for as noisy as all
        whole = counts[:, 1].sum() / max(1, n.sum())
        self.rates = np.where(n >= RATE_WORDS, counts[:, 1] / np.maximum(n, 1), whole)

    def noisy(self, confidence: float) -> bool:
        """Whether words that aren't known but could be put right are commoner at this confidence than in clean text, so that more of them are misread than new."""
        return bool(self.rates[tenth(confidence)] > 2 * self.clean_rate)

    def scores(self, f: np.ndarray) -> np.ndarray:
        out = np.full((len(f), 4), -1e6)
        blank = f[:, 0] < 0
        out[blank, BLANK] = 0
        for k, e in enumerate(self.emit):
            out[~blank, :3] = (0 if k == 0 else out[~blank, :3]) + e[:, f[~blank, k]].T
        return out

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """The likeliest states of the lines of each page; pages of like length run together."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(pages)
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        for at in range(0, len(order), 256):
            group = order[at : at + 256]
            longest = len(pages[group[-1]])
            if not longest:
                continue
            n = np.array([len(pages[i]) for i in group])
            s = np.zeros((len(group), longest, 4))
            for row, i in enumerate(group):
                s[row, : n[row]] = self.scores(pages[i])
            best, back = self.start + s[:, 0], np.zeros((len(group), longest, 4), np.int8)
            final = best.copy()
            for t in range(1, longest):
                ways = best[:, :, None] + self.step
                back[:, t] = ways.argmax(1)
                best = ways.max(1) + s[:, t]
                final[n - 1 == t] = best[n - 1 == t]
            for row, i in enumerate(group):
                path = np.empty(n[row], np.int64)
                if len(path):
                    path[-1] = final[row].argmax()
                    for t in range(len(path) - 1, 0, -1):
                        path[t - 1] = back[row, t, path[t]]
                out[i] = path
        return out


# ---- misread words and the repaired text


def right_token(token: str) -> str:
    """A mixed token whose shape isn't known, put right: letters among digits become digits, digits among letters letters."""
    parts = re.split(r"([-.,/])", token)
    for k, p in enumerate(parts):
        digits, alpha = sum(c.isdigit() for c in p), sum(c.isalpha() for c in p)
        if digits and alpha:
            parts[k] = p.translate(LETTER_AS_DIGIT) if digits >= alpha else "".join(DIGIT_AS_LETTER.get(c, c)[0] for c in p)
        elif alpha and "-" not in token and any(c.isdigit() for c in token) and p.translate(LETTER_AS_DIGIT).isdigit():
            parts[k] = p.translate(LETTER_AS_DIGIT)
    return "".join(parts)


def _cased(fix: str, like: str) -> str:
    return fix.upper() if like.isupper() and len(like) > 1 else fix.capitalize() if like[:1].isupper() else fix


def repair(lines: list[str], states: np.ndarray, odd: dict[str, str | None], known: dict[str, tuple], noisy: bool = True) -> tuple[list[int], str]:
    """The numbers of the misread lines, from 0, and the page as clean paragraphs."""
    misread: set[int] = set()
    clean = list(lines)
    torn = {i: (left, right) for i, left, right in joints(lines)}
    page = "\n".join(lines)
    # most pages have few odd words, and most lines none
    wrong = {w for w in set(_WORD.findall(page.lower())) if odd.get(w)} if noisy else set()
    mixed = any("\0" + shape(x) in odd for _, x in mixed_tokens(page))
    for i, line in enumerate(lines):
        if states[i] in (FURNITURE, BLANK):
            continue
        edits = []
        low = line.lower()
        if not mixed and i not in torn and not any(w in low for w in wrong):
            continue
        for start, token in mixed_tokens(line) if mixed else ():
            if "\0" + shape(token) in odd and right_token(token) != token:
                edits.append((start, start + len(token), right_token(token)))
        covered = [(a, b) for a, b, _ in edits]
        # the two parts of a cut word are read as one
        left_end = len(line.rstrip()) - 1 - len(torn[i][0]) if i in torn else None
        head = re.match(r"[ \t]*", line).end() if i and i - 1 in torn and states[i - 1] == BROKEN else None
        for m in _WORD.finditer(line) if any(w in low for w in wrong) else ():
            if (i in torn and states[i] == BROKEN and m.start() == left_end) or m.start() == head or any(a <= m.start() < b for a, b in covered):
                continue
            fix = odd.get(m[0].lower())
            if fix:
                edits.append((m.start(), m.end(), _cased(fix, m[0])))
        if noisy and i in torn and states[i] == BROKEN:
            whole = "".join(torn[i])
            if fix := known.get("\2" + whole.lower(), (None, 0))[0]:
                same = next((k for k, (a, b) in enumerate(zip(whole.lower(), fix, strict=False)) if a != b), min(len(fix), len(whole)))
                misread.add(i if same < len(torn[i][0]) else i + 1)
        if edits:
            misread.add(i)
            for a, b, fix in sorted(edits, reverse=True):
                clean[i] = clean[i][:a] + fix + clean[i][b:]
    paragraphs, current = [], ""
    for i, line in enumerate(clean):
        if states[i] == FURNITURE:
            continue
        if states[i] == BLANK:
            if current:
                paragraphs.append(current)
            current = ""
            continue
        text = " ".join(line.split())
        current = current + text if current.endswith("\0") else f"{current} {text}" if current else text
        current = current.replace("\0", "")
        if states[i] == BROKEN:
            current = re.sub(rf"[{HYPHENS}]\s*$", "", current) + "\0"
    if current:
        paragraphs.append(current)
    return sorted(misread), "\n\n".join(p.replace("\0", "") for p in paragraphs)


def _unpack(row) -> tuple:
    found = row.answers if row.answers is not None else []
    odd = {a["key"]: a["fix"] for a in found if a["key"][0] not in "\1\2"}
    known = {a["key"]: (a["fix"], a["n"]) for a in found if a["key"][0] in "\1\2"}
    by_document = {t["document_id"]: t["document_title"] for t in (row.titles if row.titles is not None else [])}
    counts = {k: n for k, (_, n) in known.items()}
    pages = [t.split("\n") for t in row.texts]
    return odd, known, pages, [features(p, int(n) if n == n and n is not None else -1, by_document.get(d), counts) for p, n, d in zip(pages, row.numbers, row.documents, strict=True)]


def _measure(frames):
    """What fitting needs of each block: the features of the lines of pages whose documents have a title, page by page, and counts: what is sure of these lines, then words and odd words that have a correction by confidence."""
    for f in frames:
        for row in f.itertuples(index=False):
            odd, _, _, feats = _unpack(row)
            own = [x for x in feats if len(x) and (x[:, 3] < 3).all()]
            noise = np.zeros((TENTHS + 1, 2), np.int64)
            for text, c in zip(row.texts, row.confidences, strict=True):
                found = _WORD.findall(text.lower())
                noise[tenth(c)] += len(found), sum(bool(odd.get(w)) for w in found)
            counts = np.concatenate([tally(own, [sure_states(x) for x in own]), noise.ravel()])
            yield pd.DataFrame({"sizes": [[len(x) for x in own]], "features": [b"".join(x.astype(np.int8).tobytes() for x in own)], "counts": [counts]})


def _totals(counted: DataFrame, size: int) -> np.ndarray:
    """The sums of ``counts``, place by place."""
    out = np.zeros(size, np.int64)
    for r in counted.select(F.posexplode("counts").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return out


def fit(ready: DataFrame, clean_rate: float) -> LineModel:
    """The model of all blocks: from what is sure of the lines; then they are labelled with it, and counted anew."""
    measured = materialize(spread(ready, "block").mapInPandas(_measure, "sizes array<int>, features binary, counts array<long>"), "measured")
    n = sum(TALLY)
    counts = _totals(measured, n + 2 * (TENTHS + 1))
    model = LineModel(counts[:n])
    for _ in range(FIT_ROUNDS):
        shared = ready.sparkSession.sparkContext.broadcast(model)

        def label(frames, shared=shared):
            for f in frames:
                for sizes, packed in zip(f["sizes"], f["features"], strict=True):
                    lines = np.frombuffer(packed, np.int8).reshape(-1, len(FEATURES)).astype(np.int64)
                    own = np.split(lines, np.cumsum(sizes)[:-1]) if len(sizes) else []
                    yield pd.DataFrame({"counts": [tally(own, shared.value.label(own))]})

        model = LineModel(_totals(measured.select("sizes", "features").mapInPandas(label, "counts array<long>"), n))
    model.trust(clean_rate, counts[n:].reshape(-1, 2))
    return model


def prepare(pages: DataFrame, documents: DataFrame) -> tuple[DataFrame, LineModel]:
    """The blocks with all that their pages need, and the model."""
    words = materialize(vocabulary(pages), "vocabulary")
    scans = pages.where("extraction_method = 'vision_ocr' AND text_content IS NOT NULL").select("id", "document_id", "page_number", F.col("confidence").cast("double").alias("confidence"), "text_content")
    blocks = materialize(scans.mapInPandas(_blocks, "block long, ids array<long>, documents array<long>, numbers array<int>, confidences array<double>, texts array<string>, words array<string>, breaks array<string>, halves array<string>"), "scans")
    asked, clean_rate = answers(blocks, words)
    ready = blocks.select("block", "ids", "documents", "numbers", "confidences", "texts").join(asked, "block", "left").join(titles(blocks, documents), "block", "left")
    ready = materialize(ready, "asked")
    return ready, fit(ready, clean_rate)


def clean_pages(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """(page_id, furniture, broken, misread, text) of each ``vision_ocr`` page: the line numbers of each kind, from 1, and the page as clean paragraphs.

    Lines are those of ``text_content`` split at line feeds. A null text has no
    row, an empty one no lines and an empty result. A page without a document
    or a page number is judged by its layout alone. Repeated ids count once;
    other columns are ignored. Words are known from the pages with a text
    layer; without any, no word is misread.
    """
    ready, model = prepare(pages, documents)
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(frames):
        for f in frames:
            for row in f.itertuples(index=False):
                odd, known, lines, feats = _unpack(row)
                out = []
                for page, own, states, c in zip(row.ids, lines, shared.value.label(feats), row.confidences, strict=True):
                    misread, text = repair(own, states, odd, known, shared.value.noisy(c))
                    out.append((page, [int(i) + 1 for i in np.flatnonzero(states == FURNITURE)], [int(i) + 1 for i in np.flatnonzero(states == BROKEN)], [i + 1 for i in misread], text))
                yield pd.DataFrame(out, columns=["page_id", "furniture", "broken", "misread", "text"])

    rows = spread(ready, "block").mapInPandas(run, "page_id long, furniture array<long>, broken array<long>, misread array<long>, text string")
    return rows.dropDuplicates(["page_id"])


def noisy_lines(cleaned: DataFrame) -> DataFrame:
    """(page_id, line_no, kind) of each noisy line."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("lines")) for k in ("furniture", "broken", "misread")])
    return cleaned.select("page_id", F.explode(kinds).alias("k")).select("page_id", F.explode("k.lines").alias("line_no"), F.col("k.kind").alias("kind"))
