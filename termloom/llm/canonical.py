"""Mapping freely typed values to the entries of a reference list (problem 2).

A value is first undone: look-alike and invisible characters, quotation marks, list marks and the usual phrases around
a skill ("good command of ...", "... (basic)") go; a text typed in the wrong keyboard layout has its other reading too.
Readings and entries are then folded into one alphabet, so that a transliteration equals its original, and become sets of
letter pairs of their words, whatever the order of the words, and of the letters run together.  The prefix-filter join of
these sets, tokens ordered by their rarity in all values, gives, exactly, each entry at least ``SIMILARITY`` alike; what may be less alike and still be meant (short
abbreviations, two errors in a short word) is found by keys.  Of those the best is kept if an edit distance that depends
on the length, or an abbreviation with a full stop, explains the difference.  Entries of different meaning that fit
equally well leave the value unmatched.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.session import checkpointed, large, spread

from .confusables import plain
from .set_join import PrefixIndex, similar_sets
from .terms import term

SIMILARITY = 0.4
#: With three edits of three pairs each, only entries of fewer than 21 pairs can be less alike than that, and values of up to
#: nine more; some are added, as an edit of a spelling of two letters may touch more.
SMALL_ENTRY, SMALL_VALUE = 28, 38
#: Run together, two edits keep what has more than 12 letters alike.
SMALL_JOINED = 12
#: A word of few letter pairs that is longer repeats itself; such words are all compared with each other.
LONG_WORD = 60
#: A reference list of up to so many entries is sent to all tasks (an entry takes some tens of KB there, with its keys).
IN_MEMORY = 3_000
#: Letters by the sound they are transliterated with; one sign a sound, so that distances stay the same.
SOUNDS = dict(zip("абвгдеёжзийклмнопрстуфхцчшщыэюяіїєґў", "abvgdeežzyyklmnoprstufhcčšŝyeŷŵyyegu")) | {"ъ": "", "ь": ""}
#: Spellings of one sound in Latin letters, longest first.
SPELLINGS = (("shch", "ŝ"), ("sch", "ŝ"), ("sh", "š"), ("ch", "č"), ("zh", "ž"), ("yu", "ŷ"), ("ju", "ŷ"), ("ya", "ŵ"), ("ja", "ŵ"), ("kh", "h"), ("ts", "c"), ("x", "ks"), ("q", "k"), ("w", "v"), ("j", "y"), ("i", "y"))
#: The keys of the two layouts, in the same order.
KEYS_EN, KEYS_RU = "`qwertyuiop[]asdfghjkl;'zxcvbnm,.", "ёйцукенгшщзхъфывапролджэячсмитьбю"
TO_RU, TO_EN = str.maketrans(KEYS_EN, KEYS_RU), str.maketrans(KEYS_RU, KEYS_EN)
#: Phrases that say how well a skill is known, before and behind it.
BEFORE = r"(?:уверенное |свободное )?(?:владение|знание)|знания|опыт(?: работы)?(?: с| в)?|навыки?(?: работы)?(?: с)?|умение работать с|основы|базовые знания|advanced|basic|intermediate|strong|good|proficient in|proficiency in|(?:good |strong )?(?:command|knowledge) of|(?:experience|experienced|work|working) (?:with|in)|skilled in|skills in|familiar with|expert in"
BEHIND = r",? от \d+ (?:лет|года?|мес\w*)|,? \d+\+? (?:years?|лет|года?)(?: of experience)?|:? уверенно|:? свободно|,? на (?:уровне \w+|\w+ уровне)|,? (?:базово|продвинуто)|[ ,]+(?:skills?|user|developer|expert|basics?|advanced)| v\.? ?\d+(?:\.\d+)*| \d+(?:\.\d+)+(?:\+)?| \((?:[\w+ ]*уровень|basic|advanced|intermediate|beginner|expert|базов\w*|продвинут\w*|уверенн\w*)\)"
LEADING = regex.compile(rf"\s*(?:[-–—•*·▪●►✓+>]+\s+|\(?\d+[.)]\s+|[#@](?=\w))|(?:{BEFORE})\s+(?=\S)|[\s;,:!]+")
#: Matched backwards from the end.
TRAILING = regex.compile(rf"(?r)(?:(?<=\S)(?:{BEHIND})\s*|[\s;,:!]+|\.{{2,}}|…|(?<=\w\w\w\w\w)\.)")
QUOTES = {('"', '"'), ("«", "»"), ("'", "'"), ("„", "“"), ("(", ")"), ("[", "]")}
WORDS = regex.compile(r"[\p{L}\p{N}\p{M}]+[#+]*|[#+]+")
SHORTENED = regex.compile(r"([\p{L}\p{M}]{3,})\.(?=\s|$)")
CYRILLIC, LATIN = regex.compile(r"\p{Cyrillic}"), regex.compile(r"\p{Latin}")


def undecorated(text: str) -> str:
    """The text without list marks, surrounding quotation marks and phrases about the level; never empty for that.

    Each step looks at an end of the text only, so texts of any length take linear time."""
    lo, hi = 0, len(text)
    while True:
        a, b = lo, hi
        if m := LEADING.match(text, lo, hi):
            a = m.end()
        elif m := TRAILING.match(text, lo, hi):
            b = m.start()
        while a < b and text[a].isspace():
            a += 1
        while a < b and text[b - 1].isspace():
            b -= 1
        if b - a > 2 and (text[a], text[b - 1]) in QUOTES:
            a, b = a + 1, b - 1
            while a < b and text[a].isspace():
                a += 1
            while a < b and text[b - 1].isspace():
                b -= 1
        if a >= b or (a, b) == (lo, hi):
            return text[lo:hi]
        lo, hi = a, b


@lru_cache(1 << 16)
def fold(text: str) -> str:
    """The words of a text in one alphabet: transliterated, without accents, separators as spaces."""
    text = "".join(SOUNDS.get(c, c) for c in unicodedata.normalize("NFC", text.lower()))
    if not text.isascii():
        text = "".join(c if c in "žčšŝŷŵ" else "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.combining(x)) for c in text)
    for a, b in SPELLINGS:
        if a in text:
            text = text.replace(a, b)
    return " ".join(WORDS.findall(text))


def readings(raw: str) -> list[str]:
    """What a typed value may stand for, in lower case."""
    out = []
    for choose in (lambda x: x[0], lambda x: x[-1]):
        p = plain(raw, choose).lower()
        u = undecorated(p)
        out.append(u)
        for s in (p, u):
            if not CYRILLIC.search(s):
                out.append(undecorated(s.translate(TO_RU)))
            elif not LATIN.search(s):
                out.append(undecorated(s.translate(TO_EN)))
    return list(dict.fromkeys(x for x in out if x))


def letter_pairs(folded: str) -> list[str]:
    """The distinct pairs of neighbouring letters, ends included, of each word."""
    return list(dict.fromkeys(a + b for w in folded.split() for a, b in zip("^" + w, w + "$")))


def distance(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap of neighbours) from a to b; ``most`` + 1 where there are more."""
    k, n = 0, min(len(a), len(b))
    while k < n and a[k] == b[k]:
        k += 1
    a, b = a[k:], b[k:]
    k, n = 0, min(len(a), len(b))
    while k < n and a[-1 - k] == b[-1 - k]:
        k += 1
    a, b = a[: len(a) - k], b[: len(b) - k]
    if abs(len(a) - len(b)) > most:
        return most + 1
    if not a or not b:
        return len(a) + len(b)
    far = most + 1
    before: list[int] = []
    last = [min(j, far) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        lo, hi = max(1, i - most), min(len(b), i + most)
        row = [far] * (len(b) + 1)
        row[0] = min(i, far)
        for j in range(lo, hi + 1):
            y = b[j - 1]
            d = min(last[j - 1] + (x != y), last[j] + 1, row[j - 1] + 1)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row[j] = min(d, far)
        if min(row[lo - 1 : hi + 1]) > most:
            return far
        before, last = last, row
    return last[-1]


def allowed(n: int) -> int:
    """Edits that a word or phrase of n letters may carry."""
    return 0 if n < 6 else 1 if n < 8 else 2 if n < 13 else 3


def difference(reading: str, entry: str) -> int | None:
    """0 for another way of writing the entry without any error, 1 for an abbreviation, else 1 + the number of edits;
    null where the two differ by more than that."""
    a, b = fold(reading), fold(entry)
    wa, wb = sorted(a.split()), sorted(b.split())
    if wa == wb or a.replace(" ", "") == b.replace(" ", ""):
        return 0
    if "." in reading:
        cut = {fold(m[1]) for m in SHORTENED.finditer(reading)}
        xa, xb = a.split(), b.split()
        if cut and len(xa) == len(xb) and all(x == y or x in cut and y.startswith(x) for x, y in zip(xa, xb)):
            return 1
    if [c for c in a if c.isdigit()] != [c for c in b if c.isdigit()]:
        return None
    most = allowed(sum(map(str.isalnum, entry)))
    if not most:
        return None
    forms = ((a, b), (" ".join(WORDS.findall(reading)), " ".join(WORDS.findall(entry))), (" ".join(wa), " ".join(wb)))
    found = [d for x, y in forms if (d := _distance_by_word(x.split(), y.split(), most)) is not None]
    if not found:  # words that were run together or torn apart
        d = distance(a.replace(" ", ""), b.replace(" ", ""), min(most, 2))
        found = [d] if d <= min(most, 2) and len(a.split()) != len(b.split()) else []
    return 1 + min(found) if found else None


def _distance_by_word(a: list[str], b: list[str], most: int) -> int | None:
    """The edits between texts of as many words, none with more than a typing error or two; another word is no error."""
    if len(a) != len(b):
        return None
    total = 0
    for x, y in zip(a, b):
        own = 1 if len(y) < 8 else 2
        d = distance(x, y, own)
        total += d
        if d > own or total > most:
            return None
    return total


def _similarity(reading: str, entry: str) -> float:
    """Jaccard similarity of the letter pairs by word."""
    a, b = {*letter_pairs(fold(reading))}, {*letter_pairs(fold(entry))}
    return len(a & b) / len(a | b)


def _forms(folded: str) -> list[str]:
    """A folded text, and its letters run together."""
    return list(dict.fromkeys((folded, folded.replace(" ", ""))))


def _without(word: str, most: int, before: str = "") -> set[str]:
    """``word`` and what is left of it without one letter or, if ``most`` is 2, two; each with ``before`` put before it."""
    n = len(word)
    heads, tails = [before + word[:i] for i in range(n)], [word[i + 1 :] for i in range(n)]
    found = {before + word, *map(str.__add__, heads, tails)}
    if most > 1:
        for i, head in enumerate(heads):
            tail = tails[i]
            found.update([head + tail[:k] + tail[k + 1 :] for k in range(n - i - 1)])
    return found


def keys(text: str, is_entry: bool) -> set[str]:
    """Texts that a reading and an entry have in common wherever ``difference`` takes the one for the other and their
    letter pairs, by word and run together, may be less alike than ``SIMILARITY``."""
    folded = fold(text)
    words = folded.split()
    if not words:
        return set()
    out = set()
    longest = max(range(len(words)), key=lambda i: len(words[i]), default=0)
    if is_entry:
        out |= {f"{len(words)}.{i} {w[:n]}" for i, w in enumerate(words) for n in range(1, min(len(w), 6) + 1)}
    elif SHORTENED.search(text):
        out.add(f"{len(words)}.{longest} {words[longest][:6]}")
    if len(letter_pairs(folded)) <= (SMALL_ENTRY if is_entry else SMALL_VALUE):
        for form in {folded, " ".join(WORDS.findall(text))}:
            ws = form.split()
            for w in {*ws} if is_entry else {max(ws, key=len)}:
                if len(w) <= LONG_WORD:
                    out |= _without(w, 2 if len(w) >= (8 if is_entry else 6) else 1, f"{len(ws)} ")
                if len(w) > LONG_WORD - 3:  # within two letters of a longer one
                    out.add(f"{len(ws)} long")
    joined = "".join(words)
    if len(joined) <= SMALL_JOINED + (0 if is_entry else 2):
        out |= _without(joined, 2, "1 ")
    return out


def _known(reference: DataFrame, alias: str, canonical: str) -> DataFrame:
    return reference.select(term(F.col(alias)).alias("entry"), F.col(canonical).alias("canonical")).where("entry is not null and canonical is not null").distinct()


def _judged(reading: str, entry: str) -> tuple[int, float] | None:
    """(edits, -similarity): the less, the better; null where the entry isn't meant."""
    d = difference(reading, entry)
    return None if d is None else (d, -round(_similarity(reading, entry), 6))


class Matcher:
    """The entries of a reference list that fits in memory, and the search for those that a value means."""

    def __init__(self, entries: list[tuple[str, str]], uses: dict[str, int], similarity: float):
        self.meaning: dict[str, set[str]] = {}
        for e, c in entries:
            self.meaning.setdefault(e, set()).add(c)
        forms = {f: e for e in sorted(self.meaning) for f in _forms(fold(e)) if f}
        self.entries_of: dict[str, list[str]] = {}
        for e in sorted(self.meaning):
            for f in _forms(fold(e)):
                if f:
                    self.entries_of.setdefault(f, []).append(e)
        self.index = PrefixIndex(((f, letter_pairs(f)) for f in forms), uses, similarity)
        self.keyed: dict[str, list[str]] = {}
        for e in sorted(self.meaning):
            for k in keys(e, True):
                self.keyed.setdefault(k, []).append(e)
        self.all_keys = frozenset(self.keyed)

    def candidates(self, reading: str) -> set[str]:
        found = {e for f in _forms(fold(reading)) if f for name, _ in self.index.like(letter_pairs(f)) for e in self.entries_of[name]}
        for k in self.all_keys.intersection(keys(reading, False)):
            found.update(self.keyed[k])
        return found

    def best(self, readings_: list[str]) -> tuple[str | None, int | None]:
        """(canonical, edits); null where nothing fits, or entries of different meaning fit equally well."""
        rank: dict[str, tuple[int, float]] = {}
        for r in readings_:
            for e in self.candidates(r):
                if (x := _judged(r, e)) is not None:
                    for c in self.meaning[e]:
                        rank[c] = min(rank.get(c, x), x)
        if not rank:
            return None, None
        least = min(rank.values())
        best = [c for c, x in rank.items() if x == least]
        return (best[0], least[0]) if len(best) == 1 else (None, None)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(raw_value, readings, tokens): the texts that a value may stand for, and the letter pairs of all of them."""
    for b in batches:
        found = [readings(v) for v in b.column(0).to_pylist()]
        tokens = [list({t for r in own for f in _forms(fold(r)) for t in letter_pairs(f)}) for own in found]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.string())), pa.array(tokens, pa.list_(pa.string()))], names=["raw_value", "readings", "tokens"])


def map_values(values: DataFrame, reference: DataFrame, alias: str = "alias", canonical: str = "canonical", similarity: float = SIMILARITY, in_memory: int = IN_MEMORY) -> DataFrame:
    """(raw_value, canonical, edits) of the distinct ``values.raw_value`` that are no alias themselves; canonical is null
    for those that mean no entry.

    Values whose term is an alias, null and blank values give no row.  Of several entries the one with the fewest edits
    is kept, then the most similar; if these have different canonical names the value is unmatched.  Null aliases and
    canonicals are left out; an alias that is repeated with different canonical names leaves its values unmatched.

    A reference list of up to ``in_memory`` entries goes to all tasks, and each value is matched where it is; a larger one
    is joined in shuffles.  Both give the same rows."""
    known = _known(reference, alias, canonical)
    typed = values.select("raw_value").where(F.col("raw_value").isNotNull()).distinct().withColumn("term", term(F.col("raw_value"))).where("term is not null")
    entries = known.limit(in_memory + 1).collect()
    if len(entries) > in_memory:
        typed = large(typed).join(known.select(F.col("entry").alias("term")), "term", "left_anti").select("raw_value")
        return _joined(checkpointed(spread(typed).mapInArrow(_read, _READ)), known, similarity)
    typed = typed.join(F.broadcast(known.select(F.col("entry").alias("term"))), "term", "left_anti").select("raw_value")  # at most in_memory rows
    # written down, as it is read twice; spread, as few bytes are much work here
    read = checkpointed(spread(typed).mapInArrow(_read, _READ))
    own = {t for e in entries for f in _forms(fold(e.entry)) for t in letter_pairs(f)}
    tokens = F.broadcast(values.sparkSession.createDataFrame([(t,) for t in sorted(own)], "token string"))  # the letter pairs of the entries
    uses = {r.token: r.n for r in read.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n")).join(tokens, "token").collect()}
    shared = values.sparkSession.sparkContext.broadcast({"entries": [(e.entry, e.canonical) for e in entries], "uses": uses})

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value  # a worker keeps it from task to task, and with it the index
        if "matcher" not in own:
            own["matcher"] = Matcher(own["entries"], own["uses"], similarity)
        matcher = own["matcher"]
        for b in batches:
            found = [matcher.best(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c for c, _ in found], pa.string()), pa.array([d for _, d in found], pa.int32())], names=["raw_value", "canonical", "edits"])

    return read.select("raw_value", "readings").mapInArrow(match, "raw_value string, canonical string, edits int")


_READ = "raw_value string, readings array<string>, tokens array<string>"


def _in_forms(texts: DataFrame) -> DataFrame:
    """(text, id, tokens) of the distinct ``texts`` (text): their forms, folded, with their letter pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(t, f, letter_pairs(f)) for t in b.column(0).to_pylist() for f in _forms(fold(t)) if f]
            cols = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.string(), pa.list_(pa.string())))], names=["text", "id", "tokens"])

    return texts.mapInArrow(run, "text string, id string, tokens array<string>")


def _keyed(texts: DataFrame, is_entry: bool) -> DataFrame:
    """(text, key) of the distinct ``texts`` (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):  # a text has hundreds of keys
                part = b.column(0).slice(at, 500)
                yield pa.RecordBatch.from_arrays([part, pa.array([sorted(keys(x, is_entry)) for x in part.to_pylist()], pa.list_(pa.string()))], names=["text", "keys"])

    return texts.mapInArrow(run, "text string, keys array<string>").select("text", F.explode("keys").alias("key"))


def _joined(read: DataFrame, known: DataFrame, similarity: float) -> DataFrame:
    """The mapping of ``read`` (raw_value, readings) for a reference list of any size: every step is a shuffled join."""
    reading = read.select("raw_value", F.explode("readings").alias("reading"))
    texts = checkpointed(reading.select(F.col("reading").alias("text")).distinct())
    names = checkpointed(known.select(F.col("entry").alias("text")).distinct())
    left, right = checkpointed(_in_forms(spread(texts))), checkpointed(_in_forms(spread(names)))
    one = lambda df: df.groupBy("id").agg(F.first("tokens").alias("tokens"))
    similar = similar_sets(one(left), one(right), similarity).select("left_id", "right_id")
    like = large(large(similar).join(left.select(F.col("id").alias("left_id"), F.col("text").alias("reading")), "left_id")).join(right.select(F.col("id").alias("right_id"), F.col("text").alias("entry")), "right_id").select("reading", "entry")
    by_key = large(_keyed(spread(texts), False).withColumnRenamed("text", "reading")).join(_keyed(spread(names), True).withColumnRenamed("text", "entry"), "key").select("reading", "entry")
    pairs = like.unionByName(by_key).distinct()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [_judged(r, e) for r, e in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            d = pa.array([x and x[0] for x in found], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x and x[1] for x in found], pa.float64()), d], names=["reading", "entry", "s", "edits"]).filter(d.is_valid())

    judged = spread(pairs).mapInArrow(judge, "reading string, entry string, s double, edits int")
    good = large(large(judged).join(reading.distinct(), "reading")).join(known, "entry")
    rank = F.struct("edits", "s")
    best = good.groupBy("raw_value", "canonical").agg(F.min(rank).alias("rank")).groupBy("raw_value").agg(F.min(F.struct("rank", "canonical")).alias("x"), F.collect_list(F.struct("rank", "canonical")).alias("all"))
    clear = F.size(F.filter("all", lambda y: y.rank == F.col("x.rank"))) == 1  # "all": the entries near one value
    best = best.where(clear).select("raw_value", F.col("x.canonical").alias("canonical"), F.col("x.rank.edits").alias("edits"))
    return large(read.select("raw_value")).join(best, "raw_value", "left")


def mapped_values(values: DataFrame, mapping: DataFrame) -> DataFrame:
    """(field_name, rec_id, raw_value, canonical): the records of the values that ``map_values`` matched; distinct."""
    own = mapping.where(F.col("canonical").isNotNull()).select("raw_value", "canonical")
    return values.where(F.col("rec_id").isNotNull()).select("field_name", "rec_id", "raw_value").join(own.hint("merge"), "raw_value").select("field_name", "rec_id", "raw_value", "canonical").distinct()
