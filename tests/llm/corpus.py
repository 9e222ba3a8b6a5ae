"""Small corpora made from a seed, and the plain definitions the operators are held against."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
_SYLLABLES = {
    "en": "the and ing ion ent her tha hat ere ate ver".split(),
    "de": "sch ung ein der und ich eit gen ver auf ßen".split(),
    "fr": "eau que les ion ent ait oux été aux ère eur".split(),
}


def word(rng, lang="en"):
    return "".join(rng.choice(_SYLLABLES[lang]) for _ in range(rng.randint(1, 3)))


def text(rng, words, lang="en"):
    return " ".join(word(rng, lang) for _ in range(words))


def rows(seed, count=60):
    """Documents in three languages with copies, near copies, and odd ones at the end."""
    rng, made = random.Random(seed), []
    for i in range(count):
        lang = rng.choice(list(_SYLLABLES))
        made.append([i, text(rng, rng.randint(3, 120), lang), lang, f"src{rng.randint(0, 4)}"])
    for i in range(count, count + 20):
        base = rng.choice(made)
        words = base[1].split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = word(rng)
        made.append([i, " ".join(words), base[2], base[3]])
    made += [
        [1000, None, "en", "src0"],
        [1001, "", None, None],
        [1002, " \n\t ", "en", None],
        [None, text(rng, 30), "en", "src1"],
        [1003, text(rng, 4000), "en", "src2"],
        [1003, made[0][1].upper(), "en", "src2"],
        [1004, made[0][1], None, "src0"],
        [1004, made[0][1], None, "src0"],
        [1005, "one two three", "en", ""],
        [1006, "ONE two three", "en", ""],
        [1007, "1234 5678 !!", "en", "src3"],
    ]
    return [tuple(r) + (len(r[1]) if r[1] is not None else None,) for r in made]


def words_of(value, lower=False):
    if lower:
        value = re.sub("[A-Z]+", lambda m: m[0].lower(), value or "")
    return re.findall(r"[^\x20\x09-\x0D]+", value or "")


def clashing(docs):
    """The documents with columns named like those that operators add."""
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit("x") for c in ("score", "spans", "kept", "size", "part", "key")})
