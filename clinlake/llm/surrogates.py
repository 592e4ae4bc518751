"""Personal data replaced by keyed surrogates of the same kind and format.

Numbers (phone, account, social security, IPv4) go through a keyed permutation of all numbers
of their form, so different ones stay different; e-mail addresses, secrets and
names are drawn from a keyed hash, letter for letter in the same script and
case. Names are found after a title, and then wherever their words stand in the same
document. Each word of a name has one surrogate in all documents, whichever name or
title it is part of; its ending follows the gender that the titles of the corpus tell, and
initials follow the words that start with them. Over the whole corpus the surrogates are
compared with each other and with the real entities; whoever collides is drawn again.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinlake.functions.lookup import size_at_most
from clinlake.llm.common import map_rows, saved

KEY = "surrogates"
#: Redrawn entities that are sent to every task have at most so many bytes.
REDRAWN_BYTES = 8 * 1024 * 1024

# Titles by gender, and syllables of made-up names by gender and script.
TITLES = {
    "Mr": "m", "Mister": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Signor": "m", "г-н": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Signora": "f",
    "г-жа": "f", "Dr": "n", "Prof": "n",
}
LAST_SYLLABLE = {
    ("m", "latin"): ("ton", "ric", "bert", "mond"), ("f", "latin"): ("lina", "bella", "dora", "nia"),
    ("n", "latin"): ("ley", "mar", "vin", "dell"), ("m", "cyrillic"): ("ков", "нин", "лов", "рин"),
    ("f", "cyrillic"): ("кова", "нина", "лова", "рина"), ("n", "cyrillic"): ("енко", "ских", "чук", "дзе"),
}
PARTICLES = frozenset("de da di do dos das del della der den du la le van von zu ten ter af av bin ibn al el".split())
# Capitalised words that end a name: they start a sentence, go on in a headline or follow a name.
NO_NAMES = (
    "A", "About", "After", "All", "Also", "Although", "An", "And", "Are", "As", "At", "Because", "Before", "But", "By", "Can", "Did", "Does",
    "For", "From", "Goes", "Had", "Has", "Have", "He", "Her", "His", "How", "However", "I", "If", "II", "III", "IV", "In", "Is", "It", "Its",
    "Jr", "MD", "My", "No", "Not", "Of", "On", "Or", "Our", "PhD", "Said", "Says", "She", "So", "Sr", "That", "The", "Their", "Then", "There",
    "These", "They", "This", "Those", "To", "Was", "We", "Were", "What", "When", "Where", "Who", "Why", "With", "Yes", "You", "Your",
)
ALPHABETS = {
    "latin": ("bdfgklmnprstvz", "aeiou"), "cyrillic": ("бвгдзклмнпрст", "аеиоу"), "greek": ("βγδκλμνπρστ", "αεηιο"),
}
# Ranges of code points whose letters stand for each other; others do so in rows of 128.
LETTER_RANGES = (
    (ord("a"), ord("z")), (0xDF, 0xFF), (0x100, 0x17F), (ord("ά"), ord("ώ")), (ord("а"), ord("я")), (ord("ѐ"), ord("џ")),
)

_email = re.compile(r"[^\W_][\w.+-]*@[^\W_][\w-]*(?:\.[^\W_][\w-]*)*\.[^\W\d_]{2,}")
_secret = re.compile(
    r"(?i)\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b\"?\s*[=:]\s*[\"']?([^\s\"'*#$%&!]{8,})"
    r"|(?<![^\W_])([0-9a-f]{32,128})(?![^\W_])"
)
_number = re.compile(
    r"(?<![\w.])(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)|\(\d{3}\) ?\d{3}-\d{4}(?!\d)"
    r"|\d{3}-\d{3}-\d{4}(?![\d-]))"
    r"|(?<![\w.-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\d-])"
    r"|(?<![\w.])(?P<ip>(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?!\.?\d)"
    r"|(?<!\w)(?P<account>\d{4}([ -])\d{4}\5\d{4}\5\d{1,7}|\d{13,19})(?!\w)"
)
_lower = "".join(c for c in map(chr, range(0x80, 0x10000)) if c.islower())
_capital = rf"[^\W\d_a-z{_lower}]"
_cased = "[A-Z" + "".join(c for c in map(chr, range(0x80, 0x10000)) if c.isupper() or c.istitle()) + "]"
_titles = "(?:" + "|".join(TITLES) + r")\.?[ ]"
_long = r"(?:[^\W\d_]+(?:['’]" + _capital + r"[^\W\d_]+)?|['’]" + _capital + r"[^\W\d_]+)(?![^\W\d_])"
_ends = r"(?!(?:" + "|".join(w for w in NO_NAMES if len(w) > 1) + r")\b|[AI](?![\w.'’]))"
_initials = rf"{_cased}\.(?:-?{_cased}\.)*(?!\w)|{_cased}(?=[ ]{_cased}[\w.'’])"
_particle = "(?:" + "|".join(sorted(PARTICLES)) + ")[ ]"
# Right after a title every capitalised word is a name. A name may have any number of words and initials; of words in scripts without case only two belong to it.
_name = re.compile(
    rf"(?<!\w)(?P<title>{_titles}(?:{_titles})*)(?P<name>(?:{_particle})*(?:{_initials}|{_capital}{_long}|{_ends}{_cased}(?![\w'’]))"
    rf"(?:[ -]{_ends}(?!{_cased}){_capital}{_long})?(?:(?:[ -]|(?<=\.))(?:{_particle})*{_ends}(?:{_initials}|{_cased}{_long}))*)"
)
_name_word = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_title = re.compile(r"(?<!\w)(?:" + "|".join(TITLES) + r")\.? ")
_digit = re.compile(r"\d")


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of the entities of a text, in order, none overlapping."""
    found = []
    if "@" in text:
        found += [(m.start(), m.end(), "email", m[0].lower()) for m in _email.finditer(text)]
    if _digit.search(text) or "=" in text or ":" in text:
        for m in _secret.finditer(text):
            g = 1 if m[1] else 2
            found.append((m.start(g), m.end(g), "secret", m[g].lower() if g == 2 or _is_hex(m[g]) else m[g]))
        for m in _number.finditer(text):
            kind = m.lastgroup
            found.append((m.start(), m.end(), kind, m[0] if kind == "ip" else re.sub(r"\D", "", m[0])))
    if _title.search(text):
        for m in _name.finditer(text):
            told = {TITLES[w] for w in re.split(r"[. ]+", m["title"]) if w} - {"n"}
            found.append((m.start("name"), m.end("name"), f"name-{told.pop() if len(told) == 1 else 'n'}", m["name"].casefold()))
        found += _bare(text, [text[e[0] : e[1]] for e in found if e[2].startswith("name")])
    out, end = [], 0
    for e in sorted(found, key=lambda e: (e[0], -e[1])):
        if e[0] >= end:
            out.append(e)
            end = e[1]
    return out


def _bare(text: str, names: list[str]) -> list[tuple[int, int, str, str]]:
    """Mentions without a title of the words of these names, with initials before or between them."""
    words = {w for name in names for w in _name_word.findall(name) if w not in PARTICLES and w.capitalize() not in NO_NAMES}
    long = sorted({f for w in words if len(w) > 1 for f in (w, w.upper(), w.capitalize())}, key=lambda w: (-len(w), w))
    if not long:
        return []
    word = "(?:" + "|".join(map(re.escape, long)) + r")(?![^\W\d_])"
    first = rf"(?:{_cased}\.[ -]?)*"
    pattern = re.compile(rf"(?<!\w){first}{word}(?:[ -]{first}{word})*")
    return [(m.start(), m.end(), "name-n", m[0].casefold()) for m in pattern.finditer(text)]


def keyed(found: list[tuple[int, int, str, str]]) -> list[tuple[str, str]]:
    """(kind, canonical form) of what is drawn for the entities of a text: of names every word by itself.

    A word has the gender of the titles that it has in the text if they agree, and none else.
    """
    out, told = set(), {}
    for _, _, kind, canonical in found:
        if kind.startswith("name"):
            for w in _name_word.findall(canonical):
                if len(w) > 1 and w not in PARTICLES:
                    told.setdefault(w, set()).add(kind[-1])
        else:
            out.add((kind, canonical))
    for w, genders in told.items():
        genders = genders - {"n"}
        out.add((f"name-{genders.pop() if len(genders) == 1 else 'n'}", w))
    return sorted(out)


@lru_cache(maxsize=4096)
def _letter_order(first: int, last: int, key: str) -> dict[str, str]:
    """The small letters of a range of code points in a keyed circle: each stands for the one before it."""
    letters = [c for c in map(chr, range(first, last + 1)) if c.isalpha() and c == c.casefold()]
    letters.sort(key=lambda c: _hash(key, "initial", c))
    return dict(zip(letters, letters[1:] + letters[:1], strict=True))


def _initial(letter: str, key: str) -> str:
    """The keyed letter that stands for a first letter: of initials, and of the words that start with it.

    Different letters have different ones, and none stands for itself.
    """
    letter = letter.casefold()[0]
    at = ord(letter)
    first, last = next(((lo, hi) for lo, hi in LETTER_RANGES if lo <= at <= hi), (at & ~0x7F, at | 0x7F))
    return _letter_order(first, last, key).get(letter, letter)


def _is_hex(s: str) -> bool:
    return len(s) >= 16 and all(c in "0123456789abcdefABCDEF" for c in s)


def _hash(*parts) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=32).digest(), "big")


def _permuted(value: int, size: int, *key) -> int:
    """A keyed permutation of 0..size-1: a Feistel network of two near-equal halves, walked until inside."""
    bits = max(2, (size - 1).bit_length())
    half = (bits + 1) // 2
    mask = (1 << half) - 1
    while True:
        a, b = value >> half, value & mask
        for turn in range(6):
            a, b = b, a ^ (_hash(*key, turn, b) & mask)
        value = (a << half) | b
        if value < size:
            return value


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(canonical: str, kind: str, key: str, attempt: int, keep: int = 0) -> str:
    head, tail = canonical[:keep], canonical[keep:]
    if not tail:
        return canonical
    value = int(tail)
    while True:
        # What is kept has no say in it, so that a number agrees with itself with a country code.
        value = _permuted(value, 10 ** len(tail), key, kind, attempt, len(tail))
        made = head + str(value).zfill(len(tail))
        # A number that passes the check digit test keeps passing it, and others keep failing.
        if kind != "account" or _luhn(made) == _luhn(canonical):
            return made


def _script(text: str) -> str:
    for c in text:
        if "Ѐ" <= c <= "ӿ":
            return "cyrillic"
        if "Ͱ" <= c <= "Ͽ":
            return "greek"
    return "latin"


def _letters(text: str, state: int) -> str:
    """The text with letters and digits replaced, alternating consonants and vowels of its script."""
    consonants, vowels = ALPHABETS[_script(text)]
    out, n = [], 0
    for c in text:
        if c.isdigit():
            state, r = divmod(state, 10)
            out.append(str(r))
        elif c.isalpha():
            pool = (consonants, vowels)[n % 2]
            state, r = divmod(state, len(pool))
            out.append(pool[r])
            n += 1
        else:
            out.append(c)
            n = 0
        if state < 1000:
            state = _hash(state, len(out), text)
    return "".join(out)


def surrogate(kind: str, canonical: str, key: str = KEY, attempt: int = 0) -> str:
    """The replacement of an entity in canonical form; another one for every attempt."""
    if kind == "ip":
        value = int.from_bytes(bytes(map(int, canonical.split("."))), "big")
        while True:
            value = _permuted(value, 2**32, key, kind, attempt)
            made = ".".join(map(str, value.to_bytes(4, "big")))
            if 0 < value >> 24 < 224:
                return made
    if kind in ("phone", "ssn", "account"):
        # Country codes of eleven digits and more stay.
        return _digits(canonical, kind, key, attempt, max(0, len(canonical) - 10) if kind == "phone" else 0)
    state = _hash(key, kind, canonical, attempt)
    if kind == "email":
        local, host = canonical.rsplit("@", 1)
        name, _, top = host.rpartition(".")
        return f"{_letters(local, state)}@{_letters(name, _hash(state))}.{top}"
    if kind == "secret":
        if _is_hex(canonical):
            made = ""
            while len(made) < len(canonical):
                made += f"{_hash(state, len(made)):064x}"
            return made[: len(canonical)]
        return _letters(canonical, state)
    # The stem of a name's word comes from the word alone, so that all names with it agree.
    script, state = _script(canonical), _hash(key, "name", canonical, attempt)
    consonants, vowels = ALPHABETS[script]
    ends = LAST_SYLLABLE.get((kind[-1], script), ("",))
    state, r = divmod(state, len(vowels))
    made = _initial(canonical[0], key) + vowels[r]
    for _ in range(1 + attempt):
        state, r = divmod(_hash(state, canonical), len(consonants) * len(vowels))
        made += consonants[r % len(consonants)] + vowels[r // len(consonants)]
    return made + ends[state % len(ends)]


def in_format(kind: str, written: str, made: str) -> str:
    """A surrogate in the format in which its entity was written: punctuation and case."""
    if kind in ("phone", "ssn", "account"):
        digits = iter(made)
        return "".join(next(digits) if c.isdigit() else c for c in written)
    if written.isupper():
        return made.upper()
    if kind.startswith("name"):
        return made.capitalize()
    if kind == "email" and any(c.isupper() for c in written):
        return made[0].upper() + made[1:]
    return made


def _attempts(spark, mentions: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, drawn_as, attempt) of the entities that do not get the first surrogate of their kind in the text.

    Their first surrogate collides with another or a real entity, or they are words of names
    and titles elsewhere tell more about the gender (``drawn_as`` is the kind over all texts).
    """
    texts = saved(spark, mentions.select("kind", "canonical").distinct(), "entities")
    named = F.col("kind").startswith("name")
    # One gender over all titles, or none if they tell none or both.
    told = F.array_except(F.collect_set("kind"), F.array(F.lit("name-n")))
    words = texts.where(named).groupBy("canonical").agg(told.alias("told"))
    words = words.select(F.when(F.size("told") == 1, F.col("told")[0]).otherwise("name-n").alias("kind"), "canonical")
    real = saved(spark, texts.where(~named).unionByName(words), "drawn_as")

    def drawing(attempt):
        def start():
            return lambda rows: [
                (r["kind"], r["canonical"], attempt, surrogate(r["kind"], r["canonical"], key, attempt)) for r in rows
            ]

        return start

    schema, attempt = "kind string, canonical string, attempt int, made string", 0
    drawn, final = saved(spark, map_rows(real, schema, drawing(0), text="canonical"), "drawn"), None
    while True:
        settled = drawn if final is None else final.unionByName(drawn)
        # Of several entities that drew a surrogate, the one of the earliest round and then the smallest keeps it.
        first = settled.groupBy("made").agg(F.min(F.struct("attempt", "kind", "canonical")).alias("f"))
        owner = first.select("made", F.col("f.kind").alias("k"), F.col("f.canonical").alias("c"))
        taken = real.select(F.col("canonical").alias("made")).distinct().withColumn("real", F.lit(True))
        judged = saved(
            spark,
            drawn.join(owner, "made").join(taken, "made", "left").select(
                "kind", "canonical", "attempt", "made",
                (F.col("real").isNull() & (F.col("k") == F.col("kind")) & (F.col("c") == F.col("canonical"))).alias("good"),
            ),
            "judged",
        )
        good = judged.where("good").drop("good")
        final = good if final is None else final.unionByName(good)
        again = judged.where("not good").select("kind", "canonical")
        if again.isEmpty():
            settled = final.select(
                F.col("kind").alias("drawn_as"), "canonical", "attempt",
                F.when(named, "name").otherwise(F.col("kind")).alias("group"),
            )
            grouped = texts.withColumn("group", F.when(named, "name").otherwise(F.col("kind")))
            return grouped.join(settled, ["group", "canonical"]).where("attempt > 0 or drawn_as <> kind").select(
                "kind", "canonical", "drawn_as", "attempt"
            )
        attempt += 1
        drawn = saved(spark, map_rows(again, schema, drawing(attempt), text="canonical"), "drawn")


def _free(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.casefold() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def replace_entities(docs: DataFrame, key: str = KEY) -> DataFrame:
    """Every row of a table with text: its columns, n_entities and kinds; entities replaced in the text.

    NULL and empty texts stay as they are with no entities, texts without
    entities stay byte for byte. Repeated rows are replaced alike. Columns of
    the input called n_entities or kinds are dropped; all others are kept, whatever their
    names. An empty table gives an empty one. ``key`` decides the surrogates.
    Entities that are drawn otherwise than first go to all tasks while they are few (their
    bytes are added up), and else by a join to the documents that have them.
    """
    spark = docs.sparkSession

    def seek():
        return lambda rows: [
            (r["doc_id"], kind, c)
            for r in rows
            if r["text"]
            for kind, c in keyed(entities(r["text"]))
        ]

    docs = docs.drop("n_entities", "kinds")
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    mentions = saved(
        spark,
        map_rows(docs.select("doc_id", "text"), f"doc_id {id_kind}, kind string, canonical string", seek),
        "mentions",
    )
    redrawn = saved(spark, _attempts(spark, mentions, key), "redrawn")
    source, own_again, everywhere = docs, None, {}
    if size_at_most(redrawn, REDRAWN_BYTES):
        everywhere = {(r["kind"], r["canonical"]): (r["drawn_as"], r["attempt"]) for r in redrawn.collect()}
    else:
        own_again, other_id = (_free(docs, name) for name in ("redrawn", "other_id"))
        per_doc = (
            mentions.join(redrawn, ["kind", "canonical"])
            .groupBy(F.col("doc_id").alias(other_id))
            .agg(F.to_json(F.collect_set(F.struct("kind", "canonical", "drawn_as", "attempt"))).alias(own_again))
        )
        source = docs.join(per_doc, F.col("doc_id").eqNullSafe(F.col(other_id)), "left").drop(other_id)
    columns = [f"`{c}`" for c in docs.columns]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def start():
        def work(rows):
            out = []
            for r in rows:
                text, used = r["text"], []
                if text:
                    again = everywhere
                    if own_again is not None:
                        listed = json.loads(r[own_again] or "[]")
                        again = {(e["kind"], e["canonical"]): (e["drawn_as"], e["attempt"]) for e in listed}
                    found = entities(text)
                    kind_of = {c: kind for kind, c in keyed(found) if kind.startswith("name")}

                    def made(kind, c, written):
                        drawn_as, attempt = again.get((kind, c), (kind, 0))
                        return in_format(kind, written, surrogate(drawn_as, c, key, attempt))

                    def word(m):
                        w = m[0]
                        if w in PARTICLES:
                            return w
                        return made(kind_of[w.casefold()], w.casefold(), w) if len(w) > 1 else _initial(w, key).upper()

                    parts, at = [], 0
                    for lo, hi, kind, c in found:
                        own = text[lo:hi]
                        parts += [text[at:lo], _name_word.sub(word, own) if kind.startswith("name") else made(kind, c, own)]
                        at = hi
                        used.append(kind.split("-")[0])
                    if used:
                        text = "".join(parts) + text[at:]
                out.append((*(text if c == "text" else r[c] for c in kinds), len(used), sorted(set(used))))
            return out

        return work

    schema = ", ".join(f"{q} {t}" for q, t in zip(columns, kinds.values(), strict=True))
    return map_rows(source, f"{schema}, n_entities int, kinds array<string>", start)
