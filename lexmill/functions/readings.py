"""Readings: normalisation of tones, accents and spellings as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and their plain ones, position by position.
ACCENTED = "āáǎàōóǒòēéěèīíǐìūúǔùǖǘǚǜüḿńňǹ"
PLAIN = "aaaaooooeeeeiiiiuuuuuuuuumnnn"
# Finals in the order in which they are tried, with the vowel that bears the mark.
FINALS = [
    ("a", 0), ("o", 0), ("e", 0), ("ai", 0), ("ei", 0), ("ao", 0), ("ou", 0), ("an", 0), ("en", 0), ("ang", 0), ("eng", 0), ("er", 0),
    ("i", 0), ("iu", 1), ("in", 0), ("ing", 0), ("u", 0), ("un", 0), ("ong", 0), ("v", 0),
]
MARKS = {"a": "āáǎà", "o": "ōóǒò", "e": "ēéěè", "i": "īíǐì", "u": "ūúǔù", "v": "ǖǘǚǜ"}
# Readings of punctuation.
PUNCTUATION = {"、": "-", "，": "-", "。": "-", "？": "", "《": "", "》": ""}
CEDICT = r"^\S+ (\S+) \[([^\]]+)\]"


def normalize_py(py: Column) -> Column:
    """One reading, maybe with a weight after a colon, without its tone.

    ``ü`` before ``e`` is ``u``. With a colon, ``u:e`` is ``ue``, else a final
    ``u:`` is ``v``; the tone digit of the part before the colon goes.
    """
    ue = F.regexp_replace(py, "üe", "ue")
    fixed = F.when(F.contains(ue, F.lit(":")), F.regexp_replace(F.regexp_replace(ue, "u:e", "ue"), r"u:\z", "v")).otherwise(ue)
    head = F.regexp_replace(F.substring_index(fixed, ":", 1), r"[0-5]\z", "")
    return F.concat(head, F.substring(fixed, F.length(F.substring_index(fixed, ":", 1)) + 1, 1 << 30))


def normalize_pys(pys: Column) -> Column:
    """Readings of several syllables, joined by apostrophes."""
    return F.array_join(F.transform(F.split(pys, "'"), normalize_py), "'")


def codepoint_to_chr(cp: Column) -> Column:
    """``U+4E2D`` to its character."""
    return F.decode(F.unhex(F.lpad(F.regexp_replace(cp, r"^U\+", ""), 8, "0")), "UTF-32")


def py_u_to_v(py: Column) -> Column:
    return F.regexp_replace(py, "([ln])[ǖǘǚǜü]", "$1v")


def py_rm_accent(py: Column) -> Column:
    return F.translate(F.regexp_replace(py, "m̀", "m"), ACCENTED, PLAIN)


def py_rm_tone(py: Column) -> Column:
    return F.regexp_replace(py, r"[1-5]\z", "")


def unihan_readings(prop: Column, value: Column) -> Column:
    """Readings of a property's value: by frequency, from a dictionary, by volume, or plain."""
    parts = F.split(value, r"\s+")
    after = lambda s: F.substring(s, F.instr(s, ":") + 1, 1 << 30)
    return (
        F.when(prop == "kHanyuPinlu", F.transform(parts, lambda s: py_u_to_v(py_rm_tone(F.regexp_extract(s, r"^([^0-9]+[1-5])\(([0-9]+)\)", 1)))))
        .when(prop == "kXHC1983", F.transform(parts, lambda s: py_rm_accent(py_u_to_v(after(s)))))
        .when(prop == "kHanyuPinyin", F.transform(F.flatten(F.transform(parts, lambda s: F.split(after(s), ","))), lambda s: py_rm_accent(py_u_to_v(s))))
        .when(prop == "kMandarin", F.transform(parts, lambda s: py_rm_accent(py_u_to_v(s))))
    )


def cedict_word(line: Column) -> Column:
    """The simplified word of a dictionary line; null for comments and other lines."""
    return F.when(~F.startswith(line, F.lit("#")), F.nullif(F.regexp_extract(line, CEDICT, 1), F.lit("")))


def cedict_reading(line: Column) -> Column:
    """The line's reading in lower case without tones, syllables joined; null if any syllable has no tone."""
    parts = F.split(F.regexp_extract(line, CEDICT, 2), r"\s+")
    toned = F.forall(parts, lambda s: s.rlike(r"[1-5]\z"))
    return F.when(toned, F.array_join(F.transform(parts, lambda s: F.lower(F.left(s, F.length(s) - 1))), "'"))


def finals() -> list[tuple[str, str]]:
    """Accented finals and their plain forms with the number of the tone, in the order in which they are tried."""
    out = []
    for final, at in FINALS:
        for tone, mark in enumerate(MARKS[final[at]], 1):
            out.append((final[:at] + mark + final[at + 1 :], f"{final}{tone}"))
        if final in ("a", "an"):
            out.append((final, f"{final}5"))
    return out


def normalize_word_zhuyin(py: Column) -> Column:
    """The word's reading with its last final written plainly, without the tone.

    The same final in an earlier syllable is written plainly too, but keeps the
    number of its tone.
    """
    table = finals()
    keys = F.array(*[F.lit(k) for k, _ in table])
    plain = F.create_map(*[F.lit(x) for kv in table for x in kv])
    key = F.try_element_at(F.filter(keys, lambda k: F.endswith(py, k)), F.lit(1))
    numbered = F.replace(py, key, F.element_at(plain, key))
    return F.when(key.isNull(), py).otherwise(F.left(numbered, F.length(numbered) - 1))


def sort_readings(readings: Column) -> Column:
    return F.array_sort(readings)
