"""Abusive, hateful or sexual content: a counterfactual-regularised classifier of sentences (problem 8).

The model is a logistic regression over the words, word pairs, letter n-grams and lexicon marks of a sentence, trained here on
labelled texts.  Four things shape it:

* weak priors: weights of lexicon marks are drawn to small positive values, none of which reaches the bias, so that without
  examples nothing is given out; all others are drawn to zero, the more so the more common their word is in the whole
  corpus (what every tenth record says can't be what marks a rare kind of record);
* counterfactuals that must change nothing: in sentences that name a group of people the name is swapped for others, and a
  change of the score is penalised, so that naming a group neutrally costs nothing.  Names are those of a general list and
  words of the examples that stand where those stand;
* counterfactuals that must change the label: an insult is put into a frame that mentions it without using it;
* a labelled text is a bag: only its worst sentence has to explain its label.

Words are first brought to plain characters; words with hidden, replaced, spaced out or repeated letters, or one typing
error, are recognised if they then are lexicon words.  A word that is common in the corpus is no misspelling.
A document's score is that of its worst sentence; whole texts are read.  Scoring is map-only.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.session import checkpointed

from . import lexicon
from .canonical import distance
from .confusables import plain, script

#: Labelled texts used at most, in the order of their ids.
MAX_EXAMPLES = 20_000
#: Words in a larger share of the records carry little weight of their own.
COMMON_SHARE = 0.01
#: A word in more records than this share is no misspelling of a lexicon word.
NO_TYPO_SHARE = 0.0005
#: From this score on a record is given out for review.
THRESHOLD = 0.25
#: The log-odds against a sentence of which nothing is known; no mark is drawn to a weight that would outweigh it.
BIAS = 5.0
#: Lengths of letter n-grams, ends of the word included, and examples' sentences in which one must occur.
GRAMS, MIN_GRAM = (4, 5), 3
#: The names of mark-up elements, old ones too, and of attributes without a value.
ELEMENTS = """
a abbr acronym address applet area article aside audio b base basefont bdi bdo bgsound big blink blockquote body br button canvas caption center cite code col colgroup data datalist dd del
details dfn dialog dir div dl dt em embed fieldset figcaption figure font footer form frame frameset h[1-6] head header hgroup hr html i iframe img input ins kbd keygen label legend li link
main map mark marquee math menu meta meter nav nobr noframes noindex noscript object ol optgroup option output p param path picture pre progress q rp rt ruby s samp script section select
slot small source spacer span strike strong style sub summary sup svg table tbody td template textarea tfoot th thead time title tr track tt u ul var video wbr xml xmp (?:o|v|w|m|x|st1|svg|xsl|dc|fb):\\w+
""".split()
BARE = "allowfullscreen async autofocus autoplay checked compact controls default defer disabled download hidden ismap itemscope loop multiple muted nohref noshade novalidate nowrap open readonly required reversed selected".split()
#: Mark-up; what stands between other angle brackets is text.
TAG = (
    rf"</?(?i:{'|'.join(ELEMENTS)})(?:\s+(?:[\w:@.-]+\s*=\s*(?:\"[^\"<>]*\"|'[^'<>]*'|[^\s<>\"']+)|(?i:{'|'.join(BARE)})(?=[\s/>])))*\s*/?>"
    r"|<!--[^<>]*-->|<!(?i:doctype)\b[^<>]*>|<\?(?i:xml)\b[^<>]*>"
)
SENTENCE = re.compile(r"(?<=[.!?…])[\"»”)]*\s+|[\r\n\v\f\u2028\u2029]+|(?<=[:;]\))\s+|" + TAG)
#: Longer sentences are read in windows of so many words, each beginning some words before the end of the last.
WINDOW, OVERLAP = 80, 10
SPACED = re.compile(r"(?<!\S)[^\W\d_](?:[ \u00A0][^\W\d_]){2,}(?![^\s.,!?:;»\")])")
ORDINARY = re.compile(r"[!-~]*|[А-Яа-яЁё!-/:-@\[-`{-~«»—]*")
LETTERS = regex.compile(r"[\p{L}\p{M}]+")
HEAD, TAIL = regex.compile(r"[^\p{L}\p{N}@$*#!€£|]+"), regex.compile(r"[^\p{L}\p{N}@$*#€£]+")
SEPARATED = regex.compile(r"^\p{L}(?:[^\p{L}\p{N}\s]{1,2}\p{L}){2,}$")
#: Letters set apart within a run, by the same separator or by any.
SET_APART = (
    regex.compile(r"(?<![\p{L}\p{N}])\p{L}([^\p{L}\p{N}\s]{1,2})\p{L}(?:\1\p{L})+(?![\p{L}\p{N}])"),
    regex.compile(r"(?<![\p{L}\p{N}])\p{L}(?:[^\p{L}\p{N}\s]{1,2}\p{L}){2,}(?![\p{L}\p{N}])"),
)
REPEATS = regex.compile(r"(\p{L})\1{2,}")
MASK_RUN = re.compile("([" + re.escape("*#_%&^~=?") + "])\\1+")
#: A run of one mask that is longer than any lexicon word hides one letter.
LONG_MASK = re.compile("([" + re.escape("*#_%&^~=?") + "])\\1{20,}")
#: What stands for no letter and parts the words of a run; where there is none, signs that may be masks part them.
PARTS = regex.compile(r"[^\p{L}\p{M}\p{N}" + re.escape("".join(lexicon.LEET) + lexicon.MASKS) + "]+")
JOINT = re.compile("([" + re.escape("_.-·•~=&?!|+(*#%^") + "])\\1*")
TAGS = ("insult", "beast", "intense", "person", "explicit", "suggestive", "scene", "mention", "term", "group")
_LISTS = dict(zip(TAGS, (lexicon.INSULTS, lexicon.BEASTS, lexicon.INTENSIFIERS, lexicon.PERSONS, lexicon.EXPLICIT, lexicon.SUGGESTIVE, lexicon.SCENES, lexicon.MENTIONS, lexicon.TERMS, lexicon.GROUPS)))
#: Lists whose words may be other words misspelt.
UNMARKED = {"mention", "term", "group"}
#: Lists whose words are looked for behind disguises.
_DISGUISED = ("insult", "beast", "intense", "explicit", "suggestive")
_PATTERNS = (("!threat", lexicon.THREATS), ("!dismissal", lexicon.DISMISSALS), ("!contempt", lexicon.CONTEMPT), ("!advance", lexicon.ADVANCES))
PRIOR = {
    "!insult": 0.7, "!insult+person": 0.7, "!beast+person": 0.2, "!beast+intense": 0.7, "!direct beast": 1.0, "!explicit": 1.0, "!suggestive+scene": 1.0, "!intense+person": 0.4,
    "!threat": 1.0, "!dismissal": 1.0, "!contempt": 1.0, "!advance": 1.0, "!attack": 0.3, "!aimed": 0.3, "!sexual": 0.3, "!mention": -0.7, "!insult+mention": -0.7,
}
PARENTS = {
    "!attack": {"!threat", "!dismissal", "!contempt", "!advance"},
    "!aimed": {"!insult+person", "!beast+intense", "!direct beast"},
    "!sexual": {"!explicit", "!suggestive+scene", "!advance"},
}
#: Words between an insult and the word that points at the person.
NEAR = 6


class Place:
    """One place of a pattern: the words that may stand there."""

    def __init__(self, text: str):
        parts = text.replace("ё", "е").split("/")
        self.group = "<group>" in parts
        self.exact = frozenset(x for x in parts if not x.endswith("*") and x != "<group>")
        self.stems = tuple(x[:-1] for x in parts if x.endswith("*"))
        self.weight = 0 if self.group else min(map(len, parts))

    def held(self, have: set[str], group: bool) -> bool:
        return not self.exact.isdisjoint(have) or self.group and group or bool(self.stems) and any(w.startswith(self.stems) for w in have)


class Words:
    """Lexicon marks of words; what is once seen is remembered."""

    def __init__(self, no_typos: frozenset[str] = frozenset(), groups: frozenset[str] = frozenset()):
        self.exact: dict[str, set[str]] = {x: {"group"} for x in groups}
        self.stems: dict[str, set[str]] = {}
        for tag, entries in _LISTS.items():
            for e in entries:
                e = e.replace("ё", "е")
                (self.stems if e.endswith("*") else self.exact).setdefault(e.rstrip("*"), set()).add(tag)
        self.hidden = [(e, stem) for d, stem in ((self.exact, False), (self.stems, True)) for e, tags in d.items() if len(e) >= 3 and tags & {*_DISGUISED}]
        self.by_first: dict[str, list[int]] = {}
        for k, (e, _) in enumerate(self.hidden):
            self.by_first.setdefault(e[0], []).append(k)
        self.near: dict[str, list[tuple[str, bool]]] = {}
        for e, stem in self.hidden:
            if len(e) >= 5:
                for x in _deletions(e):
                    self.near.setdefault(x, []).append((e, stem))
        self.no_typos = no_typos
        # a pattern is looked at where a word of its longest place occurs
        self.exact_lines: dict[str, list[tuple[str, list[Place]]]] = {}
        self.stem_lines: dict[str, list[tuple[str, list[Place]]]] = {}
        for mark, lines in _PATTERNS:
            for line in lines.strip().replace("\n", "|").split("|"):
                if places := [Place(x) for x in line.split()]:
                    key = max(places, key=lambda x: x.weight)
                    rest = mark, [x for x in places if x is not key]
                    for x in key.exact:
                        self.exact_lines.setdefault(x, []).append(rest)
                    for x in key.stems:
                        self.stem_lines.setdefault(x, []).append(rest)
        self.longest = max(map(len, (*self.stems, *self.stem_lines)))
        self.info: dict[str, tuple[frozenset[str], tuple, bool]] = {}
        self.seen: dict[str, tuple[str, ...]] = {}

    def tags(self, word: str) -> set[str]:
        found = set(self.exact.get(word, ()))
        for n in range(3, min(len(word), self.longest) + 1):
            if x := self.stems.get(word[:n]):
                found |= x
        return found

    def about(self, word: str) -> tuple[frozenset[str], tuple, bool]:
        """The lists a word is in, the patterns that are looked at where it occurs, and whether it may begin a mark at all."""
        got = self.info.get(word)
        if got is None:
            if len(self.info) > 400_000:
                self.info.clear()
            lines = [*self.exact_lines.get(word, ())]
            for n in range(3, min(len(word), self.longest) + 1):
                lines += self.stem_lines.get(word[:n], ())
            tags = frozenset(self.tags(word))
            got = self.info[word] = tags, tuple(lines), bool(lines) or not tags.isdisjoint(_DISGUISED)
        return got

    def typo_of(self, word: str) -> str | None:
        """The lexicon word that ``word`` misses by one typing error (first letter right, five letters or more)."""
        if len(word) < 5:
            return None
        for n in range(4, min(len(word), 16) + 1):
            for x in _deletions(word[:n]):
                for e, stem in self.near.get(x, ()):
                    if e[0] == word[0] and (stem or n == len(word)) and distance(word[:n], e, 1) <= 1:
                        return e
        return None

    def unmask(self, chunk: str) -> str | None:
        """The lexicon word behind a chunk with replaced or hidden letters; half of the letters at least must be there.
        A run of one mask hides as many letters as it has characters, or a single one."""
        if chunk.isalpha() and (chunk.isascii() or len({*map(script, chunk)}) == 1):
            return None
        for form in {chunk: 0, MASK_RUN.sub(r"\1", chunk): 0}:
            for e, stem in self._may_hide(form):
                n = len(e)
                if n > len(form) or not stem and n != len(form):
                    continue
                plainly = 0
                for c, y in zip(form, e):
                    if c == y:
                        plainly += 1
                    elif not (y in lexicon.LEET.get(c, "") or c in lexicon.MASKS or c.isalpha() and c.isascii() != y.isascii()):
                        break
                else:
                    if plainly >= max(2, n / 2 - 0.5):
                        return e + "".join(c for c in form[n:] if c.isalpha())
        return None

    def _may_hide(self, form: str) -> list[tuple[str, bool]]:
        """The lexicon words, in their order, whose first letter ``form`` can begin with and whose letters it has some of."""
        scripts = {c.isascii() for c in form if c.isalpha()}
        if not scripts:
            return []
        first = form[0]
        if first in lexicon.MASKS:
            found = range(len(self.hidden))
        else:
            starts = {first, *lexicon.LEET.get(first, "")}
            found = sorted({k for y in starts for k in self.by_first.get(y, ())} | ({k for y, own in self.by_first.items() if y.isascii() != first.isascii() for k in own} if first.isalpha() and len(scripts) > 1 else set()))
        return [self.hidden[k] for k in found if self.hidden[k][0].isascii() in scripts]

    def of(self, chunk: str) -> tuple[str, ...]:
        """The words of a chunk of non-space characters, lower-cased and undisguised."""
        got = self.seen.get(chunk)
        if got is None:
            got = self._read(chunk)
            if len(chunk) <= 100:
                if len(self.seen) > 400_000:
                    self.seen.clear()
                self.seen[chunk] = got
        return got

    def _read(self, chunk: str) -> tuple[str, ...]:
        text = (chunk if ORDINARY.fullmatch(chunk) else plain(chunk)).lower().replace("ё", "е")
        text = _trimmed(text)
        if len(text) > 100:
            text = LONG_MASK.sub(r"\1", REPEATS.sub(r"\1", text))
        if len(text) > 100:
            return self._parts(text)
        if SEPARATED.match(text):
            text = "".join(c for c in text if c.isalpha())
        text = REPEATS.sub(r"\1", text)
        if text.isalpha():
            return (self._word(text),)
        if (e := self.unmask(text)) is not None:
            return (e,)
        return self._parts(text)

    def _parts(self, text: str) -> tuple[str, ...]:
        """The words of a run that is no word itself: each part is read for itself, with what hides it."""
        for p in SET_APART:
            text = p.sub(lambda m: _apart("".join(c for c in m[0] if c.isalpha())), text)
        parts = [x for x in PARTS.split(text) if x]
        if len(parts) == 1 and (joints := Counter(m[1] for m in JOINT.finditer(parts[0]))):
            order = sorted(joints, key=lambda c: (c in "*#%^", -joints[c]))
            at = order[0]
            if len(order) > 1 and len(parts[0]) <= 100:
                at = next((c for c in order if any(x and self.unmask(x) for x in parts[0].split(c))), at)
            parts = [x for x in parts[0].split(at) if x]
        if parts == [text]:
            return tuple(map(self._word, LETTERS.findall(text)))
        return tuple(w for x in parts for w in self.of(x))

    def _word(self, w: str) -> str:
        if w in self.no_typos or self.tags(w) - UNMARKED:
            return w
        if not w.isascii() and (e := self.unmask(w)) is not None:
            return e
        return self.typo_of(w) or w


def _deletions(word: str) -> set[str]:
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


def _trimmed(text: str) -> str:
    """The text without the signs at its ends, in one pass."""
    text = text[m.end() :] if (m := HEAD.match(text)) else text
    return text[: len(text) - m.end()] if (m := TAIL.match(text[::-1])) else text


def _apart(word: str) -> str:
    """A word of letters set apart; where the first may be a word of its own, without it too."""
    return f"{word} {word[1:]}" if word[0].lower() in "aiавикосуя" else word


def _joined(m: re.Match) -> str:
    return _apart(m[0].replace(" ", "").replace("\u00a0", ""))


def sentences(text: str) -> list[str]:
    if SPACED.search(text):
        text = SPACED.sub(_joined, text)
    return [s for s in SENTENCE.split(text) if s]


def windows(text: str, words: Words) -> Iterator[list[str]]:
    """The words of each sentence of a text; of a very long one in overlapping windows."""
    of = words.of
    for s in sentences(text):
        ws = [w for c in s.split() for w in of(c)]
        if len(ws) <= WINDOW:
            if ws:
                yield ws
        else:
            for at in range(0, len(ws) - OVERLAP, WINDOW - OVERLAP):
                yield ws[at : at + WINDOW]


def marks(ws: list[str], words: Words) -> list[str]:
    """The lexicon marks of a sentence; none where no word may begin one, whatever else is mentioned."""
    out = []
    where: dict[str, list[int]] = {}
    lines = []
    about = [words.about(w) for w in ws]
    if not any(begins for _, _, begins in about):
        return out
    for i, (tags, own, _) in enumerate(about):
        for t in tags:
            where.setdefault(t, []).append(i)
        lines += own
    insults, persons = where.get("insult"), where.get("person", ())
    if insults:
        out.append("!insult")
        # by itself, strengthened, or as what someone completely is, it is addressed to someone
        strong = any(0 < b - a <= 2 for b in insults for a in where.get("intense", ())) or any(_direct(ws[max(0, a - 3) : a]) for a in insults)
        if strong or len(ws) <= 2 or any(abs(a - b) <= NEAR for a in insults for b in persons):
            out.append("!insult+person")
        if "mention" in where or "term" in where:
            out.append("!insult+mention")
    if "beast" in where:
        if persons:
            out.append("!beast+person")
        if any(0 < b - a <= 2 for b in where["beast"] for a in where.get("intense", ())):
            out.append("!beast+intense")
        if any(_direct(ws[max(0, b - 3) : b]) for b in where["beast"]):
            out.append("!direct beast")
    if "explicit" in where:
        out.append("!explicit")
    if "suggestive" in where and any(a != b for a in where["suggestive"] for b in where.get("scene", ())):
        out.append("!suggestive+scene")
    if "intense" in where and persons:
        out.append("!intense+person")
    if "mention" in where:
        out.append("!mention")
    if lines:
        have, group = set(ws), "group" in where
        out += sorted({mark for mark, places in lines if all(x.held(have, group) for x in places)})
    # what kinds of marks have in common is learned from all of them
    return out + [parent for parent, kinds in PARENTS.items() if not kinds.isdisjoint(out)]


def _direct(before: list[str]) -> bool:
    """Whether the words before a name of an animal or a thing say that it is a person."""
    last = before[-1:]
    if last and last[0] in ("a", "an", "the", "such", "total", "complete"):
        return "you" in before or "complete" in before
    return bool(last) and last[0] in ("ты", "вы", "you", "тот", "этот", "полный", "полная", "отсюда", "одного", "lost") or before[-2:-1] == ["тот"]


def grams(word: str) -> set[str]:
    """The letter n-grams of a word, as features; what errors and disguises leave of a word is known by them."""
    w = f"^{word[:60]}$"
    return {"#" + w[i : i + n] for n in GRAMS for i in range(len(w) - n + 1)}


class _Weights(dict):
    """Weights of words with those of their n-grams; what is once added up is remembered."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.all = weights

    def __missing__(self, word: str) -> float:
        if len(self) > 400_000:
            self.clear()
        got = self.all.get(word, 0.0) + sum(map(self.all.get, self.all.keys() & grams(word)))
        self[word] = got
        return got


@dataclass
class Model:
    """Weights by feature; ``no_typos`` are the common words that resemble lexicon words, ``groups`` the names of groups that
    were learned."""

    weights: dict[str, float]
    bias: float
    no_typos: frozenset[str] = frozenset()
    groups: frozenset[str] = frozenset()
    _ready: tuple | None = field(default=None, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_ready": None}

    def score(self, text: str | None) -> float:
        """The probability that the text's worst sentence offends; 0 for null, empty and blank texts."""
        if not text:
            return 0.0
        if self._ready is None:
            after: dict[str, dict[str, float]] = {}
            for f, w in self.weights.items():
                if " " in f and f[0] not in "!#":
                    a, b = f.split(" ")
                    after.setdefault(a, {})[b] = w
            self._ready = Words(self.no_typos, self.groups), after, _Weights(self.weights)
        words, after, weight = self._ready
        info, worst = words.info.get, -math.inf
        for ws in windows(text, words):
            z, last, marked = self.bias, "<", False
            for w in ws:
                z += weight[w]
                if (own := after.get(last)) is not None:
                    z += own.get(w, 0.0)
                if not marked and (info(w) or words.about(w))[2]:
                    marked = True
                last = w
            if marked:
                z += sum(self.weights.get(x, 0.0) for x in marks(ws, words))
            if z > worst:
                worst = z
        return 0.0 if worst == -math.inf else 1 / (1 + math.exp(-max(-50.0, min(50.0, worst))))


def features(ws: list[str], words: Words) -> Counter[str]:
    """Words, word pairs, letter n-grams and marks of a sentence, with their numbers."""
    return Counter([*ws, *(a + " " + b for a, b in zip(["<", *ws], ws)), *(g for w in ws for g in grams(w)), *marks(ws, words)])


class _Sparse:
    """Feature counts of sentences, in three arrays; features without a number are left out."""

    def __init__(self, index: dict[str, int]):
        self.index, self.n = index, 0
        self.rows, self.cols, self.counts = array("i"), array("i"), array("f")

    def add(self, feats: Counter[str]) -> None:
        for f, k in feats.items():
            if (i := self.index.get(f)) is not None:
                self.rows.append(self.n)
                self.cols.append(i)
                self.counts.append(k)
        self.n += 1

    def ready(self) -> _Sparse:
        self.r, self.c, self.v = (np.asarray(x) for x in (self.rows, self.cols, self.counts))
        return self

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.r, self.v * w[self.c], self.n) if self.n else np.zeros(0)

    def back(self, y: np.ndarray) -> np.ndarray:
        return np.bincount(self.c, self.v * y[self.r], len(self.index)) if self.n else np.zeros(len(self.index))


def learned_groups(rows: list[list[str]], offends: list[bool], words: Words) -> frozenset[str]:
    """Words of offending texts that stand between the same two words as names of groups do, in two such places at least."""
    about = lambda w: words.about(w)[0]
    places: dict[str, set[tuple[str, str]]] = {}
    known = set()
    for ws, bad in zip(rows, offends):
        if bad:
            for a, w, b in zip(["<", *ws], ws, [*ws[1:], ">"]):
                places.setdefault(w, set()).add((a, b))
                if "group" in about(w):
                    known.add((a, b))
    return frozenset(w for w, own in places.items() if len(own & known) >= 2 and not about(w) and len(w) > 3)


def fit(texts: list[tuple[str, bool]], common: frozenset[str] = frozenset(), no_typos: frozenset[str] = frozenset(), swaps: int = 4, balance: float = 2.0, rounds: int = 4) -> Model:
    """A model of labelled texts (text, offends).

    ``swaps``: counterfactuals made of each sentence that names a group; ``balance``: the weight of their penalty."""
    words = Words(no_typos)
    rows, bag = [], []
    for t, (text, _) in enumerate(texts):
        for ws in windows(text, words):
            rows.append(ws)
            bag.append(t)
    if not rows:
        return Model(dict(PRIOR), -BIAS, no_typos)
    groups = learned_groups(rows, [texts[t][1] for t in bag], words)
    words = Words(no_typos, groups)
    insults = sorted({w for ws, t in zip(rows, bag) if texts[t][1] for w in ws if "insult" in words.about(w)[0]})
    framed = [list(windows(f.format(w), words)) for f in lexicon.FRAMES for w in insults if w.isascii() == f.isascii()]
    rows += [ws for found in framed for ws in found]

    seen: Counter[str] = Counter()
    for ws in rows:
        seen.update(features(ws, words).keys())
    names = sorted({f for f, n in seen.items() if n >= (MIN_GRAM if f[0] == "#" else 2)} | {*PRIOR})
    index = {f: i for i, f in enumerate(names)}
    x, twins, twin_of = _Sparse(index), _Sparse(index), []
    rng = np.random.default_rng(5)
    pools = {own: sorted(g for g, tags in words.exact.items() if "group" in tags and g.isascii() == own) for own in (True, False)}
    for i, ws in enumerate(rows):
        x.add(features(ws, words))
        if here := [k for k, w in enumerate(ws) if "group" in words.about(w)[0]]:
            for _ in range(swaps):
                other = list(ws)
                for k in here:
                    pool = pools[ws[k].isascii()]
                    other[k] = pool[rng.integers(len(pool))]
                twins.add(features(other, words))
                twin_of.append(i)
    x.ready(), twins.ready()

    prior = np.array([PRIOR.get(f, 0.0) for f in names])
    # a common word moves little; a pair is as common as its rarer word at most
    rare = np.array([not all(w in common or w == "<" for w in f.split(" ")) for f in names])
    strength = np.where([f in PRIOR for f in names], 0.02, np.where([f[0] == "#" for f in names], 1.0, np.where(rare, 0.25, 1.0)))
    bags, label = np.array(bag), np.array([y for _, y in texts], bool)
    order = np.argsort(bags, kind="stable")
    edges = np.searchsorted(bags[order], np.arange(len(texts) + 1))
    w, b = prior.copy(), -BIAS
    for _ in range(rounds):
        z = x.dot(w) + b
        y = np.zeros(len(rows))
        for t in np.flatnonzero(label):
            own = order[edges[t] : edges[t + 1]]
            if len(own):
                y[own[np.argmax(z[own])]] = 1
        w, b = _descend(x, y, twins, np.array(twin_of, int), prior, strength, balance, w, b)
    return Model({f: float(v) for f, v in zip(names, w) if abs(v) > 1e-4}, float(b), no_typos, groups)


def _descend(x: _Sparse, y: np.ndarray, twins: _Sparse, twin_of: np.ndarray, prior, strength, balance: float, w, b, steps: int = 150, rate: float = 0.08):  # noqa: ANN001, ANN202
    """Adam on the sum of log losses + strength * (w - prior)^2 / 2 + the squared change of scores under swaps."""
    n = len(y)
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        z = x.dot(w)
        p = 1 / (1 + np.exp(-np.clip(z + b, -50, 50)))
        change = z[twin_of] - twins.dot(w)
        pull = np.bincount(twin_of, change, n) if len(twin_of) else 0.0
        slope = x.back(p - y + balance * pull) - balance * twins.back(change)
        g = np.append(slope + strength * (w - prior), (p - y).sum() + 0.3 * (b + BIAS)) / n
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def corpus_words(df: DataFrame, text_col: str = "text") -> tuple[frozenset[str], frozenset[str]]:
    """(common words, words that are no misspelling) of the whole corpus.

    Texts of the same words and figures are one text, so that a copied misspelling becomes no ordinary word.  Both sets are
    bounded: the first by the mean number of distinct words of a record over ``COMMON_SHARE``, the second by the words
    within one error of the lexicon."""
    runs = F.regexp_extract_all(F.translate(F.lower(F.col(text_col)), "ё", "е"), F.lit(r"(\p{L}+|\p{N}+)"))
    texts = df.where(F.col(text_col).isNotNull()).select(F.concat_ws(" ", F.array(F.lit("")), F.array_distinct(runs)).alias("t")).distinct()
    # each text begins with an empty word, whose count is that of the texts
    counts = checkpointed(texts.select(F.explode(F.split("t", " ")).alias("word")).where((F.col("word") == "") | F.col("word").rlike(r"^\p{L}")).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") > 2))
    n = counts.where("word = ''").agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    counts = counts.where((F.col("word") != "") & (F.col("n") > n * NO_TYPO_SHARE))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for b in batches:
            like = [words.typo_of(x) is not None and not words.tags(x) - UNMARKED for x in b.column(0).to_pylist()]
            often = [x > n * COMMON_SHARE for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(often, pa.bool_()), pa.array(like, pa.bool_())], names=["word", "often", "alike"]).filter(pa.array([x or y for x, y in zip(often, like)], pa.bool_()))

    rows = counts.mapInArrow(wanted, "word string, often boolean, alike boolean").collect()
    return frozenset(r.word for r in rows if r.often), frozenset(r.word for r in rows if r.alike)


def train(examples: DataFrame, corpus: DataFrame, clean_label: str = "none", max_examples: int = MAX_EXAMPLES) -> Model:
    """The model of labelled ``examples`` (example_id, text, label) for ``corpus`` (text).

    The first ``max_examples`` by id are used; null texts and labels are left out."""
    rows = examples.where("text is not null and label is not null").orderBy("example_id").limit(max_examples).select("text", "label").collect()
    common, no_typos = corpus_words(corpus)
    return fit([(r.text, r.label != clean_label) for r in rows], common, no_typos)


def score_documents(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` without ``text_col``, with ``score`` (0 to 1) and ``offends``; a row for every row.

    Null, empty and blank texts score 0; other columns and their nulls are kept as they are."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # a weight a feature of the examples
    keep = [c for c in df.columns if c not in (text_col, "score", "offends")]
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            s = [m.score(t) for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s, pa.float64()), pa.array([x >= THRESHOLD for x in s], pa.bool_())], names=[*keep, "score", "offends"])

    kinds = ", ".join(f"`{c}` {k}" for c, k in src.dtypes[:-1])
    return src.mapInArrow(run, f"{kinds + ', ' if kinds else ''}score double, offends boolean")


def rates(scored: DataFrame, by: str = "source") -> DataFrame:
    """(by, n_docs, n_offending, rate, mean_score); null is a source of its own."""
    bad = F.sum(F.col("offends").cast("long"))
    return scored.groupBy(by).agg(F.count("*").alias("n_docs"), bad.alias("n_offending"), (bad / F.count("*")).alias("rate"), F.avg("score").alias("mean_score"))
