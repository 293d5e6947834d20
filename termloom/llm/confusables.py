"""One consistent form for text that looks alike but is made of other characters (problem 4).

Script-aware repair: forms of presentation (full width, mathematical, ligatures), decomposed accents, unusual spaces and
hyphens and invisible characters are brought to their plain form; then, in each unbroken run of letters that mixes
scripts, look-alikes are put into the run's dominant script.  A run whose scripts tie is decided by the vocabulary of
the whole corpus: the reading that occurs there as a word, the more frequent one if both do.  Runs of one script, and
runs with a letter that has no look-alike in the dominant script, keep their letters.  Look-alikes are known for Latin,
Cyrillic, Greek, Armenian, Cherokee and Lisu.  A dotless i is a letter of its own in some languages: it is one more tie.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.session import checkpointed, large, spread

#: Letters of one script that look like letters of another (small letters also where their capitals do).
LATIN_CYRILLIC = dict(zip("AaBbCcEeHhIiJjKkMmOoPpSsTtXxYyËëӘəÏï", "АаВвСсЕеНнІіЈјКкМмОоРрЅѕТтХхУуЁёӘәЇї"))
CYRILLIC_LATIN = {c: x for x, c in LATIN_CYRILLIC.items()} | dict(zip("һԁԛԝҮүӀ", "hdqwYyI"))
GREEK_LATIN = dict(zip("ΑαΒΕεΖΗηΙιΚκΜΝνΟοΡρΤτΥυΧχϹϲϳ", "AaBEeZHnIiKkMNvOoPpTtYuXxCcj"))
GREEK_CYRILLIC = dict(zip("ΑαΒΓΕΗΙιΚκΛΜΟοΠπΡρΤτΥυΦφΧχ", "АаВГЕНІіКкЛМОоПпРрТтУуФфХх"))
ARMENIAN_LATIN = dict(zip("օոսհզցյքգռՕՏՍ", "onuhqgjfqnOSU"))
CHEROKEE_LATIN = dict(zip("ᎠᎡᎢᎥᎩᎪᎫᎬᎳᎷᎻᎽᏀᏂᏃᏏᏒᏔᏕᏙᏚᏞᏟᏢᏦᏧᏳᏴꭵꮁꮃꮓꮩꮪꮯ", "DRTiyAJEWMHYGhZbRWSVSLCPKdGBirwzvsc"))
LISU_LATIN = dict(zip("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"))
TO = {("LATIN", "CYRILLIC"): LATIN_CYRILLIC, ("CYRILLIC", "LATIN"): CYRILLIC_LATIN, ("GREEK", "LATIN"): GREEK_LATIN, ("GREEK", "CYRILLIC"): GREEK_CYRILLIC}
for _name, _table in (("ARMENIAN", ARMENIAN_LATIN), ("CHEROKEE", CHEROKEE_LATIN), ("LISU", LISU_LATIN)):
    _back = {x: c for c, x in reversed(_table.items())}
    TO["LATIN", _name] = _back
    for _to, _own in (("LATIN", {x: x for x in _table.values()}), ("CYRILLIC", LATIN_CYRILLIC)):
        TO[_name, _to] = {c: _own[x] for c, x in _table.items() if x in _own}
    TO["CYRILLIC", _name] = {c: _back[x] for c, x in CYRILLIC_LATIN.items() if x in _back}
SCRIPTS = {x for pair in TO for x in pair}
#: Latin letters that look like plain ones.
PLAIN_LETTERS = dict(zip("ɑɡɩɪȷᴄᴏᴜʋᴠᴡᴢꜱʏ", "agiijcouuvwzsy"))
#: Punctuation of other forms, by its plain form.
PLAIN_MARKS = {**dict.fromkeys("‐‑‒–−⁃﹣－﹘", "-"), **dict.fromkeys("‘’‚‛ʼ′＇", "'"), **dict.fromkeys("“”„‟″＂", '"'), "⁄": "/", "∕": "/", "․": ".", "꞉": ":", "∶": ":", "ǃ": "!"}
#: Kinds of compatibility form that are another look of the same character.
FORMS = ("<wide>", "<narrow>", "<font>", "<noBreak>", "<circle>", "<initial>", "<medial>", "<final>", "<isolated>")

LETTERS = regex.compile(r"\p{L}+")
SPACES = regex.compile(r"\p{White_Space}+")
PLAIN_SPACES = regex.compile(r"[ \t\r\n\x0b\x0c]+")
#: Invisible characters; joiners and selectors stay inside a sequence of emoji.
INVISIBLE = regex.compile(
    r"(?<!\p{Extended_Pictographic}\uFE0F?|\p{Emoji_Modifier})\u200D|\u200D(?!\p{Extended_Pictographic})"
    r"|(?<![\p{Extended_Pictographic}0-9#*])\uFE0F"
    r"|(?<!\U0001F3F4[\U000E0020-\U000E007F]*)[\U000E0020-\U000E007F]"
    r"|[[\p{Cf}\p{Variation_Selector}\u115F\u1160\u3164\uFFA0\u034F\u17B4\u17B5]--[\u200D\uFE0F\U000E0020-\U000E007F]]|[\p{Cc}--\p{White_Space}]",
    regex.V1,
)
#: A Java pattern: values that can't need a change hold these characters only.
ORDINARY = r"^[\x09\x0A\x0D\x20-\x7EА-Яа-яЁё]*$"
MIXED = r"[A-Za-z][А-Яа-яЁё]|[А-Яа-яЁё][A-Za-z]"


def script(ch: str) -> str:
    """LATIN, CYRILLIC, GREEK, ARMENIAN, CHEROKEE, LISU or, for any other letter, OTHER."""
    if ch < "\x80":
        return "LATIN"
    name = unicodedata.name(ch, "").split(" ", 1)[0]
    return name if name in SCRIPTS else "OTHER"


def _form(ch: str) -> str:
    if ch in PLAIN_MARKS:
        return PLAIN_MARKS[ch]
    if ch in PLAIN_LETTERS:
        return PLAIN_LETTERS[ch]
    kind = unicodedata.decomposition(ch).split(" ", 1)[0]
    if kind in FORMS or (kind == "<compat>" and unicodedata.category(ch)[0] == "L" or unicodedata.category(ch) == "Nl" and kind):
        plain = unicodedata.normalize("NFKC", ch)
        return "".join(PLAIN_MARKS.get(x, x) for x in plain)
    return ch


def read_as(run: str, to: str) -> str | None:
    """A run of letters in one script; null where a letter has no look-alike in it."""
    out = []
    for ch in run:
        s = script(ch)
        if s == to:
            out.append(ch)
        elif x := TO.get((s, to), {}).get(ch):
            out.append(x)
        else:
            return None
    return "".join(out)


def readings(run: str) -> list[str]:
    """What a run of letters may stand for: one reading where a script dominates or nothing can be replaced, else the
    readings of the tying scripts; with a dotless i also that with a plain one."""
    if run.isascii():
        return [run]
    n = Counter(map(script, run))
    if len(n) == 1:
        found = [run]
    else:
        most = max(n.values())
        found = [x for s in sorted(n) if n[s] == most and (x := read_as(run, s)) is not None] or [run]
    return found + [x.replace("ı", "i") for x in found if "ı" in x]


def _open(run: str, ask: bool) -> list[str]:
    found = readings(run)
    return list(dict.fromkeys([run, *found])) if ask else found


def plain(text: str, choose: Callable[[list[str]], str] = lambda found: found[0], ask: bool = False) -> str:
    """The consistent form of a text; ``choose`` decides between the readings of a run whose scripts tie.  With ``ask`` it
    decides on every run of letters that would change, of which it is then given the run itself and the readings."""
    text = "".join(map(_form, text)) if not text.isascii() else text
    text = INVISIBLE.sub("", unicodedata.normalize("NFC", text))
    text = unicodedata.normalize("NFC", text)
    if not text.isascii():
        text = LETTERS.sub(lambda m: x[0] if len(x := _open(m[0], ask)) == 1 else choose(x), text)
    return SPACES.sub(" ", text).strip(" ")


def squeezed(text: str) -> str:
    """The text with surplus plain spaces, tabs and line ends taken out."""
    return PLAIN_SPACES.sub(" ", text).strip(" ")


def _ties(text: str, ask: bool) -> list[list[str]]:
    found: list[list[str]] = []
    plain(text, lambda x: found.append(x) or x[0], ask)
    return found


VOCABULARY = ("ties", "always")


def clean_values(values: DataFrame, vocabulary: str = "ties") -> DataFrame:
    """(field_name, rec_id, raw_value, clean_value) of the ``values`` (the same without the last) whose characters must
    change; distinct rows.

    ``vocabulary``: what the words of the corpus decide.  With ``ties`` a run of mixed letters takes its dominant script and
    they decide where none dominates; with ``always`` look-alikes are replaced only where the result occurs as a word of
    the corpus, and the run stays as it is elsewhere.

    Null values and records are no case, nor are empty and blank ones, nor surplus plain white space alone.  A value
    of nothing but invisible characters comes out as an empty string.  Only values with unusual or mixed characters leave
    the JVM, once."""
    if vocabulary not in VOCABULARY:
        raise ValueError(f"unknown use of the vocabulary: {vocabulary}")
    ask = vocabulary == "always"
    row = ["field_name", "rec_id", "raw_value"]
    values = values.where(F.col("rec_id").isNotNull() & F.col("raw_value").isNotNull())
    odd = values.select(*row).where(~F.col("raw_value").rlike(ORDINARY) | F.col("raw_value").rlike(MIXED)).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            clean = [plain(t) for t in texts]
            found = [_ties(t, ask) for t in texts]
            change = pa.array([bool(x) or c != squeezed(t) for c, t, x in zip(clean, texts, found)], pa.bool_())
            ties = pa.array(found, pa.list_(pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(clean, pa.string()), ties], names=[*row, "clean_value", "ties"]).filter(change)

    # few bytes, much work: over many tasks; written down, as it is read twice
    made = checkpointed(spread(odd).mapInArrow(run, "field_name string, rec_id string, raw_value string, clean_value string, ties array<array<string>>"))
    sure = made.where(F.size("ties") == 0).drop("ties")
    open_ = made.where(F.size("ties") > 0)

    # all words of all values, counted once; of a run that is to be confirmed the run itself counts for nothing
    words = values.select(F.explode(F.regexp_extract_all(F.lower("raw_value"), F.lit(r"(\p{L}+)"))).alias("word")).groupBy("word").agg(F.count("*").alias("uses"))
    tied = open_.select(F.explode("ties").alias("tie")).distinct()
    options = tied.select("tie", F.posexplode("tie").alias("pos", "reading")).withColumn("word", F.lower("reading"))
    uses = F.when(F.lit(ask) & (F.col("pos") == 0), 0).otherwise(F.coalesce("uses", F.lit(0)))
    best = large(options).join(words, "word", "left").groupBy("tie").agg(F.max_by("reading", F.struct(uses, -F.col("pos"))).alias("reading"))
    chosen = (
        large(open_.select(*row, F.explode("ties").alias("tie"))).join(best, "tie").groupBy(*row).agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("\x00", "tie"), "reading"))).alias("chosen"))
    )  # the ties of one value: no more than it has words

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            clean = [plain(t, lambda x, own=dict(m): own["\x00".join(x)], ask) for t, m in zip(texts, b.column(3).to_pylist())]
            change = pa.array([c != squeezed(t) for c, t in zip(clean, texts)], pa.bool_())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(clean, pa.string())], names=[*row, "clean_value"]).filter(change)

    decided = chosen.mapInArrow(decide, "field_name string, rec_id string, raw_value string, clean_value string")
    return sure.unionByName(decided)
