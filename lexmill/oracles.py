"""The queries in SQL, for a second engine."""

from __future__ import annotations

from lexmill.functions.chars import HAN, NUMBERS, PUNCT, STRIP, TERMINATORS
from lexmill.operators import lexicon as lex
from lexmill.operators.corpus import _OTHER, _OTHER_OR_END, SENTENCE
from lexmill.operators.crf.features import TEMPLATES, Template
from lexmill.operators.wordfilter import PREFIXES, SUFFIXES
from lexmill.queries import (
    AFFIX_LINES, ARPA, BLOCK_LINES, CEDICT, DICTIONARY_PAGES, FIELD_LINES, KEEP_ABOVE, LEXICON_LINES, PAGES, PINYIN, RANK_LINES, RANKS, STROKE_LINES, TAGS, UNIHAN, UNIHAN_LINES,
    ZHUYIN,
)


# Accented letters and their plain ones, readings of punctuation.
ACCENTED = "āáǎàōóǒòēéěèīíǐìūúǔùǖǘǚǜüḿńňǹ"
PLAIN = "aaaaooooeeeeiiiiuuuuuuuuumnnn"
PUNCTUATION = {"、": "-", "，": "-", "。": "-", "？": "", "《": "", "》": ""}


def _s(value: object) -> str:
    return "NULL" if value is None else str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def _values(rows: list[tuple], name: str, columns: str) -> str:
    return f"{name}({columns}) AS (VALUES " + ", ".join("(" + ", ".join(map(_s, r)) + ")" for r in rows) + ")"


def _set(letters: str) -> str:
    return "(" + ", ".join(_s(c) for c in letters) + ")"


_LINES = """
lines AS (
  SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, parts[i] AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL), unnest(range(1, len(parts) + 1)) AS t(i))
"""
_KEPT = _LINES + rf""",
kept AS (
  SELECT doc_id, line_no, regexp_replace(line, {_s(STRIP)}, '', 'g') AS line FROM lines WHERE regexp_matches(line, '[^\x00-\x7f]'))
"""
_TOKENS = _KEPT + f""",
matches AS (
  SELECT doc_id, line_no, CAST(i - 1 AS INTEGER) AS sent_no, ms[i] AS m
  FROM (SELECT doc_id, line_no, regexp_extract_all(line, {_s(SENTENCE)}) AS ms FROM kept), unnest(range(1, len(ms) + 1)) AS t(i)),
led AS (
  SELECT doc_id, line_no, sent_no, s, regexp_extract(s, {_s('^' + _OTHER + _OTHER_OR_END + '*')}) AS lead
  FROM (SELECT *, regexp_replace(m, {_s('^[ ' + chr(9) + TERMINATORS + ']+')}, '') AS s FROM matches)),
parted AS (
  SELECT *, regexp_extract_all(substr(s, length(lead) + 1), {_s(f'[{HAN}{PUNCT}{TERMINATORS}]|{_OTHER}+')}) AS r FROM led),
tokens AS (
  SELECT doc_id, line_no, sent_no,
    CASE WHEN lead = '' THEN [] ELSE [regexp_replace(lead, {_s('[' + TERMINATORS + ']')}, '', 'g')] END
    || CASE WHEN regexp_matches(s, {_s(_OTHER + chr(92) + 'z')}) THEN r[1:len(r) - 1] ELSE r END AS tokens
  FROM parted)
"""
_STORE = "store AS (SELECT word, CAST(sum(coalesce(freq, 0)) AS BIGINT) AS freq FROM words WHERE word IS NOT NULL GROUP BY word)"
_LEX = "lexwords AS (SELECT DISTINCT word FROM lexicon_freq)"
_KILL = f"""
CASE WHEN length(word) = 1 THEN 'is_single_character'
  WHEN NOT regexp_matches(word, '^[{HAN}]') THEN 'is_not_chinese_word'
  WHEN substr(word, 1, 1) IN {_set(NUMBERS)} AND right(word, 1) IN {_set(NUMBERS)} THEN 'is_number'
  WHEN length(word) = 2 AND substr(word, 1, 1) = right(word, 1) THEN 'is_AA'
  WHEN substr(word, 1, 1) IN {_set(PREFIXES)} OR right(word, 1) IN {_set(SUFFIXES)} THEN 'is_stop_word' END
"""
_SEGMENTED = _LINES + f""",
segmented AS (
  SELECT DISTINCT doc_id, w AS word
  FROM (SELECT doc_id, unnest(string_split(regexp_replace(line, {_s(STRIP)}, '', 'g'), '/')) AS w FROM lines WHERE contains(line, '/')) WHERE w <> '')
"""
_KNOWN_CHARS = "chars AS (SELECT ch, readings[1] AS py FROM char_readings WHERE ch IS NOT NULL AND len(readings) > 0)"
_OWN = "own(ch, py) AS (VALUES " + ", ".join(f"({_s(k)}, {_s(v)})" for k, v in PUNCTUATION.items()) + ")"


def _reading(source: str) -> str:
    """CTEs ``read(word, reading)`` of the words of ``source``."""
    return f"""{_KNOWN_CHARS}, {_OWN},
table_of AS (SELECT ch, py FROM own UNION ALL SELECT ch, py FROM chars WHERE ch NOT IN (SELECT ch FROM own)),
each AS (SELECT word, i, substr(word, i, 1) AS ch FROM {source}, unnest(range(1, length(word) + 1)) AS t(i)),
read AS (
  SELECT word, CASE WHEN count(*) = count(py) THEN string_agg(py, '''' ORDER BY i) END AS reading
  FROM each LEFT JOIN table_of USING (ch) GROUP BY word)"""


def _normal(x: str) -> str:
    ue = f"replace({x}, 'üe', 'ue')"
    fixed = f"CASE WHEN contains({ue}, ':') THEN regexp_replace(replace({ue}, 'u:e', 'ue'), 'u:\\z', 'v') ELSE {ue} END"
    return f"regexp_replace(split_part({fixed}, ':', 1), '[0-5]\\z', '') || substr({fixed}, length(split_part({fixed}, ':', 1)) + 1)"


_IDS = f"""
ids AS (
  SELECT word, row_number() OVER (ORDER BY line_no) + {lex.FIRST_ID - 1} AS id,
    coalesce(array_to_string(list_transform(readings, lambda r: array_to_string(list_transform(string_split(r, ''''), lambda p: {_normal('p')}), '''')), ' '), '') AS readings
  FROM lexicon_freq)
"""
_HEAD = _values(list(lex.HEAD.items()), "head", "word, id")
_ACCENT = f"translate(replace(%s, 'm̀', 'm'), '{ACCENTED}', '{PLAIN}')"
_UTOV = "regexp_replace(%s, '([ln])[ǖǘǚǜü]', '\\1v')"
_AFTER = "substr(s, strpos(s, ':') + 1)"
_UNIHAN = _values(UNIHAN, "unihan", "line_no, cp, prop, value") + f""",
named AS (SELECT *, chr(CAST('0x' || substr(cp, 3) AS INTEGER)) AS ch, list_position({lex.PRIORITY}, prop) AS rank FROM unihan WHERE prop IN {tuple(lex.PRIORITY)}),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ch ORDER BY rank, line_no) AS k FROM named WHERE unicode(ch) BETWEEN 13312 AND 40959) WHERE k = 1),
spoken AS (
  SELECT ch, prop, list_sort(list_distinct(CASE prop
    WHEN 'kHanyuPinlu' THEN list_transform(string_split(value, ' '), lambda s: {_UTOV % "regexp_replace(split_part(s, '(', 1), '[1-5]$', '')"})
    WHEN 'kXHC1983' THEN list_transform(string_split(value, ' '), lambda s: {_ACCENT % (_UTOV % _AFTER)})
    WHEN 'kHanyuPinyin' THEN list_transform(flatten(list_transform(string_split(value, ' '), lambda s: string_split({_AFTER}, ','))), lambda s: {_ACCENT % (_UTOV % 's')})
    ELSE list_transform(string_split(value, ' '), lambda s: {_ACCENT % (_UTOV % 's')}) END)) AS readings
  FROM best)
"""
_GOLD = _LINES + """,
gold AS (
  SELECT doc_id, line_no, list_filter(string_split(line, '/'), lambda w: w <> '') AS ws FROM lines WHERE contains(line, '/')),
letters AS (
  SELECT doc_id, line_no, flatten(list_transform(ws, lambda w: string_split(w, ''))) AS tokens,
    flatten(list_transform(ws, lambda w: list_transform(range(1, length(w) + 1), lambda k:
      CASE WHEN length(w) = 1 THEN 'S' WHEN k = 1 THEN 'B' WHEN k = length(w) THEN 'E' ELSE 'M' END))) AS tags
  FROM gold WHERE len(ws) > 0),
places AS (SELECT doc_id, line_no, tokens, len(tokens) AS n, CAST(i AS INTEGER) AS i FROM letters, unnest(range(0, len(tokens))) AS t(i))
"""


def _cell(k: int) -> str:
    return f"CASE WHEN i + {k} < 0 THEN '_B' || (i + {k}) WHEN i + {k} >= n THEN '_B+' || (i + {k} - n + 1) ELSE tokens[i + {k} + 1] END"


_FEATURES = ", ".join(" || ".join(_s(p) if isinstance(p, str) else f"({_cell(p[0])})" for p in Template(t).pieces) for t in TEMPLATES[:-1])
_FEATURED = _GOLD + f", featured AS (SELECT doc_id, line_no, i, [{_FEATURES}] || CASE WHEN i > 0 THEN ['B'] ELSE [] END AS fs FROM places)"
# Each final with its four tones (and the neutral one of a and an); the longest spelling does not matter, as no final ends in another with its mark.
_TONES = [
    ("a", "ā á ǎ à"), ("o", "ō ó ǒ ò"), ("e", "ē é ě è"), ("ai", "āi ái ǎi ài"), ("ei", "ēi éi ěi èi"), ("ao", "āo áo ǎo ào"), ("ou", "ōu óu ǒu òu"),
    ("an", "ān án ǎn àn"), ("en", "ēn én ěn èn"), ("ang", "āng áng ǎng àng"), ("eng", "ēng éng ěng èng"), ("er", "ēr ér ěr èr"), ("i", "ī í ǐ ì"),
    ("iu", "iū iú iǔ iù"), ("in", "īn ín ǐn ìn"), ("ing", "īng íng ǐng ìng"), ("u", "ū ú ǔ ù"), ("un", "ūn ún ǔn ùn"), ("ong", "ōng óng ǒng òng"), ("v", "ǖ ǘ ǚ ǜ"),
]
_NUMBERED = [(marked, f"{plain}{k}") for plain, row in _TONES for k, marked in enumerate(row.split(), 1)] + [("a", "a5"), ("an", "an5")]
_FINALS = "CASE " + " ".join(f"WHEN suffix(py, {_s(k)}) THEN left(replace(py, {_s(k)}, {_s(v)}), -1)" for k, v in _NUMBERED) + " ELSE py END"


_MOVES = [[-4.0, 1.0, 0.25, -4.0], [0.5, -4.0, -4.0, 0.25], [-4.0, 0.5, -0.5, -4.0], [0.5, -4.0, -4.0, 0.125]]


def _paths() -> str:
    """CTE ``paths(doc_id, line_no, sent_no, tokens, i, s, p)``: per last tag the best score and its path."""
    special = _set("的了在是一不，。！？、")
    emit = [f"CASE WHEN tokens[%s] IN {special} THEN {w} ELSE 0.0 END" for w in (-1.0, -1.0, -2.0, 2.0)]
    scores, ways = [], []
    for t, tag in enumerate(TAGS):
        a = [f"(s[{u + 1}] + {_MOVES[u][t]})" for u in range(4)]
        scores.append(f"greatest({', '.join(a)}) + {emit[t] % 'i + 1'}")
        pick = " ".join(f"WHEN {a[u]} = greatest({', '.join(a)}) THEN p[{u + 1}]" for u in range(4))
        ways.append(f"CASE {pick} END || '{tag}'")
    first = ", ".join(f"CAST({e % 1} AS DOUBLE)" for e in emit)
    return f"""paths AS (
  SELECT doc_id, line_no, sent_no, tokens, 1 AS i, [{first}] AS s, ['B', 'E', 'M', 'S'] AS p FROM tokens WHERE len(tokens) > 0
  UNION ALL
  SELECT doc_id, line_no, sent_no, tokens, i + 1, [{', '.join(f'CAST({x} AS DOUBLE)' for x in scores)}], [{', '.join(ways)}] FROM paths WHERE i < len(tokens)),
best AS (
  SELECT doc_id, line_no, sent_no, tokens, greatest(s[1], s[2], s[3], s[4]) AS score, p[list_position(s, greatest(s[1], s[2], s[3], s[4]))] AS tags
  FROM paths WHERE i = len(tokens))"""


def _marginals() -> str:
    """CTEs ``fwd`` and ``bwd``: logarithms of the sums over all beginnings that end in a tag, and over all endings that follow it."""
    special = _set("的了在是一不，。！？、")

    def emit(t: int, at: str) -> str:
        return f"CASE WHEN tokens[{at}] IN {special} THEN {(-1.0, -1.0, -2.0, 2.0)[t]} ELSE 0.0 END"

    def total(terms: list[str]) -> str:
        top = f"greatest({', '.join(terms)})"
        return f"{top} + ln({' + '.join(f'exp({x} - {top})' for x in terms)})"

    first = ", ".join(f"CAST({emit(t, '1')} AS DOUBLE)" for t in range(4))
    on = ", ".join(f"CAST({total([f'(a[{u + 1}] + {_MOVES[u][t]})' for u in range(4)])} + {emit(t, 'i + 1')} AS DOUBLE)" for t in range(4))
    back = ", ".join(f"CAST({total([f'(b[{t + 1}] + {_MOVES[u][t]} + {emit(t, chr(105))})' for t in range(4)])} AS DOUBLE)" for u in range(4))
    z = total([f"a[{t}]" for t in range(1, 5)])
    return f"""fwd AS (
  SELECT doc_id, line_no, sent_no, tokens, 1 AS i, [{first}] AS a FROM tokens WHERE len(tokens) > 0
  UNION ALL SELECT doc_id, line_no, sent_no, tokens, i + 1, [{on}] FROM fwd WHERE i < len(tokens)),
bwd AS (
  SELECT doc_id, line_no, sent_no, tokens, len(tokens) AS i, [CAST(0 AS DOUBLE), 0, 0, 0] AS b FROM tokens WHERE len(tokens) > 0
  UNION ALL SELECT doc_id, line_no, sent_no, tokens, i - 1, [{back}] FROM bwd WHERE i > 1),
whole AS (SELECT doc_id, line_no, sent_no, {z} AS z FROM fwd WHERE i = len(tokens)),
probs AS (
  SELECT f.tokens[f.i] AS token, [exp(f.a[t] + b.b[t] - z) for t in [1, 2, 3, 4]] AS p
  FROM fwd f JOIN bwd b ON f.doc_id = b.doc_id AND f.line_no = b.line_no AND f.sent_no = b.sent_no AND f.i = b.i
  JOIN whole w ON f.doc_id = w.doc_id AND f.line_no = w.line_no AND f.sent_no = w.sent_no)"""


def _grams(n: int) -> str:
    return (
        f"SELECT array_to_string(tokens[i:i + {n - 1}], ' ') AS gram, count(*) AS n, {n} AS \"order\" "
        f"FROM tokens, unnest(range(1, len(tokens) - {n - 2})) AS t(i) WHERE len(tokens) >= {n} GROUP BY 1"
    )


ORACLES = {
    "ascii_line_drop": f"WITH {_KEPT} SELECT * FROM kept",
    "sentence_split": f"WITH {_TOKENS} SELECT doc_id, line_no, sent_no, array_to_string(tokens, ' ') AS tokens FROM tokens",
    "token_counts": f"WITH {_TOKENS} SELECT token, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM tokens) GROUP BY token",
    "sentence_lengths": f"WITH {_TOKENS} SELECT CAST(len(tokens) AS INTEGER) AS n_tokens, count(*) AS n FROM tokens GROUP BY 1",
    "char_class_profile": f"""WITH {_LINES}, each AS (SELECT unnest(string_split(line, '')) AS ch FROM lines)
      SELECT regexp_matches(ch, '^[{HAN}]') AS zh, regexp_matches(ch, {_s('^[' + PUNCT + '!?,;.！？，。…]')}) AS punct, ch IN {_set(TERMINATORS)} AS terminator,
        ch IN {_set(NUMBERS)} AS number, count(*) AS n FROM each WHERE ch <> '' GROUP BY ALL""",
    "segmented_word_files": f"WITH {_SEGMENTED} SELECT word, count(*) AS n_docs FROM segmented GROUP BY word",
    "word_freq": f"WITH {_TOKENS} SELECT token AS gram, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM tokens) GROUP BY token",
    "ngram_counts": f"WITH {_TOKENS} {_grams(2)} UNION ALL {_grams(3)}",
    "word_kill_reasons": f"""WITH {_STORE}, {_LEX}, judged AS (
      SELECT coalesce({_KILL}, CASE WHEN word IN (SELECT word FROM lexwords WHERE word IS NOT NULL) THEN 'is_known_word' END, 'kept') AS reason FROM store)
      SELECT reason, count(*) AS n FROM judged GROUP BY reason""",
    "word_keep": f"WITH {_STORE} SELECT word FROM store WHERE {_KILL} IS NULL",
    "stopword_affix": f"WITH {_STORE} SELECT word FROM store WHERE substr(word, 1, 1) IN {_set(PREFIXES)} OR right(word, 1) IN {_set(SUFFIXES)}",
    "known_word_anti": f"WITH {_STORE}, {_LEX} SELECT word FROM store ANTI JOIN lexwords USING (word) WHERE {_KILL} IS NULL",
    "known_word_semi": f"WITH {_STORE}, {_LEX} SELECT word FROM lexwords SEMI JOIN store USING (word)",
    "new_minus_existing": f"WITH {_SEGMENTED} SELECT word FROM segmented EXCEPT SELECT word FROM lexicon_freq",
    "extract_new_words": f"""WITH {_SEGMENTED}, {_STORE}, found AS (SELECT DISTINCT word FROM segmented)
      SELECT word, freq FROM found JOIN store USING (word) WHERE {_KILL} IS NULL AND freq > {KEEP_ABOVE} AND word NOT IN (SELECT word FROM lexicon_freq WHERE word IS NOT NULL)""",
    "extract_without_engine": f"""WITH {_SEGMENTED} SELECT DISTINCT word, CAST(1 AS BIGINT) AS freq FROM segmented
      WHERE {_KILL} IS NULL AND word NOT IN (SELECT word FROM lexicon_freq WHERE word IS NOT NULL)""",
    "freq_lookup_threshold": f"WITH {_STORE}, {_LEX} SELECT word, freq FROM lexwords JOIN store USING (word) WHERE freq > {KEEP_ABOVE}",
    "freq_route_three_way": f"""WITH {_STORE}, {_LEX}, looked AS (SELECT word, coalesce(freq, 0) AS freq FROM lexwords LEFT JOIN store USING (word))
      SELECT word, CASE WHEN length(word) <> 1 THEN freq ELSE -1 END AS freq,
        CASE WHEN length(word) = 1 OR freq > {KEEP_ABOVE} OR word IN (SELECT ch FROM char_readings) THEN 'keep' WHEN freq = 0 THEN 'remove' ELSE 'wait' END AS route FROM looked""",
    "dict_filter": f"""WITH {_STORE}, {_LEX}, looked AS (SELECT word, coalesce(freq, 0) AS freq FROM lexwords LEFT JOIN store USING (word))
      SELECT * FROM looked WHERE length(word) = 1 OR freq <> 0""",
    "hit_count_parse": f"""WITH {_values(PAGES, 'pages', 'word, engine, page')} SELECT word, engine, CAST(CASE engine
      WHEN 'baidu' THEN coalesce(TRY_CAST(replace(regexp_extract(page, '找到相关结果约?([0-9,]+)个', 1), ',', '') AS BIGINT), 0)
      WHEN 'google' THEN coalesce(TRY_CAST(replace(regexp_extract(page, '获得约 <b>([0-9,]+)</b> 条结果', 1), ',', '') AS BIGINT), 0)
      ELSE CASE WHEN contains(page, '未找到和您的关键词') THEN 0 ELSE 1 END END AS BIGINT) AS freq FROM pages""",
    "wordstore_upsert": "SELECT word, arg_max_null(freq, entry_id) AS freq, max(entry_id) AS seq FROM words WHERE word IS NOT NULL AND freq IS NOT NULL GROUP BY word",
    "wordstore_delete": f"WITH {_STORE}, {_LEX} SELECT * FROM store ANTI JOIN lexwords USING (word)",
    "wordstore_get": f"WITH {_STORE}, {_LEX} SELECT word, coalesce(freq, -1) AS freq FROM lexwords LEFT JOIN store USING (word)",
    "wordstore_resume": """WITH named AS (SELECT * FROM lexicon_freq WHERE word IS NOT NULL),
      pick AS (SELECT word FROM named ORDER BY freq DESC NULLS LAST, word LIMIT 1)
      SELECT line_no, word FROM named WHERE line_no > (SELECT min(line_no) FROM named WHERE word = (SELECT word FROM pick))""",
    "lexicon_shrink": """SELECT line_no, word, word || ' ' || coalesce(array_to_string(readings, ' '), '') AS line FROM lexicon_freq
      WHERE length(word) = 1 OR coalesce(freq, 0) >= 8000""",
    "lexicon_counts": "SELECT count(*) AS n_in, count(*) FILTER (length(word) = 1 OR coalesce(freq, 0) >= 8000) AS n_out FROM lexicon_freq",
    "lexicon_plane_filter": f"""WITH {_values([(900001, '𠀀', 1), (900002, '豈', 1), (900003, '豈更', 1)], 'extra', 'line_no, word, freq')},
      every_line AS (SELECT line_no, word, freq FROM lexicon_freq UNION ALL SELECT * FROM extra)
      SELECT line_no, word FROM every_line WHERE NOT (length(word) = 1 AND (unicode(word) > 65535 OR unicode(word) BETWEEN 63744 AND 64255))""",
    "lexicon_assign_id": f"WITH {_IDS} SELECT * FROM ids",
    "lexicon_head_union": f"""WITH {_IDS}, {_HEAD}
      SELECT word || ' ' || id || CASE WHEN readings <> '' THEN ' ' || readings ELSE '' END AS line FROM ids UNION ALL SELECT word || ' ' || id FROM head""",
    "lexicon_concat": f"WITH {_SEGMENTED} SELECT word FROM lexicon_freq UNION ALL (SELECT word FROM segmented EXCEPT SELECT word FROM lexicon_freq)",
    "lexicon_lint": """WITH every_entry AS (SELECT word, readings FROM lexicon_freq UNION ALL SELECT ch, readings FROM char_readings),
      each AS (SELECT word, split_part(r, ':', 1) AS py FROM (SELECT word, unnest(readings) AS r FROM every_entry)),
      single AS (SELECT DISTINCT word AS ch, py FROM each WHERE length(word) = 1),
      terms AS (SELECT DISTINCT substr(word, i, 1) AS ch, string_split(py, '''')[i] AS py, word
        FROM each, unnest(range(1, least(length(word), len(string_split(py, ''''))) + 1)) AS t(i) WHERE length(word) > 1)
      SELECT ch, py, word FROM terms ANTI JOIN single USING (ch, py)""",
    "word_to_pinyin": f"WITH {_STORE}, {_reading('store')} SELECT word, reading FROM read",
    "cedict_parse": f"""WITH {_values(CEDICT, 'cedict', 'line_no, line')},
      parsed AS (SELECT regexp_extract(line, '^\\S+ (\\S+) \\[([^\\]]+)\\]', 1) AS word, string_split(regexp_extract(line, '^\\S+ (\\S+) \\[([^\\]]+)\\]', 2), ' ') AS ps
        FROM cedict WHERE NOT starts_with(line, '#'))
      SELECT word, array_to_string(list_transform(ps, lambda p: lower(left(p, length(p) - 1))), '''') AS reading FROM parsed
      WHERE word <> '' AND len(list_filter(ps, lambda p: NOT regexp_matches(p, '[1-5]$'))) = 0""",
    "pinyin_normalize": f"WITH {_values([(p,) for p in PINYIN], 'pinyin', 'py')} SELECT py, {_normal('py')} AS normal FROM pinyin",
    "zhuyin_normalize": f"WITH {_values([(p,) for p in ZHUYIN], 'zhuyin', 'py')} SELECT py, {_FINALS} AS normal FROM zhuyin",
    "unihan_priority": f"WITH {_UNIHAN} SELECT ch, prop, array_to_string(readings, ' ') AS readings FROM spoken",
    "unihan_merge": f"""WITH {_UNIHAN},
      counted AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY line_no) AS nth FROM lexicon_freq WHERE word IS NOT NULL)
      SELECT line_no, word, coalesce(array_to_string(CASE WHEN length(word) = 1 AND nth = 1 AND s.readings IS NOT NULL
        AND len(list_filter(coalesce(c.readings, []), lambda r: contains(r, ':'))) = 0 THEN s.readings ELSE c.readings END, ' '), '') AS readings
      FROM counted c LEFT JOIN spoken s ON c.word = s.ch
      UNION ALL SELECT 0, ch, array_to_string(readings, ' ') FROM spoken WHERE ch NOT IN (SELECT word FROM counted)""",
    "reading_sort": "SELECT line_no, array_to_string(list_sort(readings), ' ') AS readings FROM lexicon_freq WHERE readings IS NOT NULL",
    "html_reading_extract": _values([(w, {"行": "háng xíng"}.get(w, "")) for w, _ in DICTIONARY_PAGES], "WITH pages", "word, readings") + " SELECT * FROM pages",
    "reading_validate": f"""WITH {_STORE}, {_reading('store')},
      scraped AS (SELECT word, min(readings[1]) AS py FROM lexicon_freq WHERE word IS NOT NULL AND readings IS NOT NULL GROUP BY word),
      other AS (SELECT word, {_FINALS} AS other FROM scraped)
      SELECT word, coalesce(other, reading) AS reading, coalesce(other <> reading, false) AS differs
      FROM read LEFT JOIN other USING (word) WHERE reading IS NOT NULL AND length(word) > 1""",
    "stroke_sort_rank": """WITH known AS (SELECT list(ch) AS chs FROM char_readings),
      keyed AS (SELECT line_no, word, list_transform(string_split(word, ''), lambda c: [unicode(c) % 23 + 1, unicode(c)]) AS key FROM lexicon_freq, known
        WHERE word IS NOT NULL AND len(list_filter(string_split(word, ''), lambda c: NOT list_contains(chs, c))) = 0)
      SELECT line_no, word, row_number() OVER (ORDER BY key, line_no) AS rank FROM keyed""",
    "collation_sort_rank": """SELECT line_no, word, row_number() OVER (ORDER BY length(word), word COLLATE zh, word, line_no) AS rank FROM lexicon_freq WHERE word IS NOT NULL""",
    "arpa_rank_sort": f"""WITH {_values(ARPA, 'arpa', 'line_no, line')}, {_values([(w, k) for k, w in enumerate(RANKS)], 'ranks', 'word, rank')},
      sections AS (SELECT *, starts_with(line, chr(92)) AS is_header, sum(CASE WHEN starts_with(line, chr(92)) THEN 1 ELSE 0 END) OVER (ORDER BY line_no) AS section FROM arpa),
      fields AS (SELECT line_no, i, len(string_split(line, ' ')) AS n, string_split(line, ' ')[i] AS f FROM arpa, unnest(range(1, len(string_split(line, ' ')) + 1)) AS t(i)),
      keys AS (SELECT line_no, list(CASE WHEN i = n THEN -1 ELSE coalesce(rank, -1) END ORDER BY i) AS key FROM fields LEFT JOIN ranks ON f = word GROUP BY line_no)
      SELECT line_no, line, CAST(section AS INTEGER) AS section, row_number() OVER (ORDER BY section, is_header DESC, key, line_no) AS place
      FROM sections JOIN keys USING (line_no)""",
    "crf_features": f"WITH {_FEATURED} SELECT doc_id, line_no, i, array_to_string(fs, ' ') AS features FROM featured",
    "crf_feature_counts": f"WITH {_FEATURED} SELECT feature, count(*) AS n FROM (SELECT unnest(fs) AS feature FROM featured) GROUP BY feature HAVING count(*) >= 2",
    "crf_tagset": f"""WITH {_GOLD}, used AS (SELECT DISTINCT unnest(tags) AS tag FROM letters)
      SELECT tag, CAST(row_number() OVER (ORDER BY tag) - 1 AS INTEGER) AS tag_id FROM used""",
    "crf_viterbi": f"WITH RECURSIVE {_TOKENS}, {_paths()} SELECT doc_id, line_no, sent_no, tags, round(score, 6) AS score FROM best",
    "crf_marginals": f"""WITH RECURSIVE {_TOKENS}, {_marginals()}
      SELECT token, tag, round(sum(p[k]), 3) AS expected, count(*) AS n FROM probs, (VALUES (1, 'B'), (2, 'E'), (3, 'M'), (4, 'S')) AS t(k, tag) GROUP BY token, tag""",
    "crf_results": f"""WITH RECURSIVE {_GOLD}, tokens AS (SELECT doc_id, line_no, 0 AS sent_no, tokens FROM letters), {_paths()}
      SELECT CAST(list_position(['B', 'E', 'M', 'S'], best.tags[i]) - 1 AS INTEGER) AS tag_id, CAST(list_position(['B', 'E', 'M', 'S'], g.tags[i]) - 1 AS INTEGER) AS gold_id, count(*) AS n
      FROM best JOIN letters g USING (doc_id, line_no), unnest(range(1, len(g.tags) + 1)) AS t(i) GROUP BY 1, 2""",
    "crf_model_shape": "SELECT 4 AS ysize, 2 AS n_templates, 12 AS dsize, 60 AS maxid, 60 AS n_active, CAST(1 AS DOUBLE) AS cost_factor",
    "segment_words": f"""WITH RECURSIVE {_TOKENS}, {_paths()} SELECT doc_id, line_no, sent_no,
      coalesce(array_to_string(list_transform(range(1, len(tokens)), lambda k: CASE WHEN k > 1 AND tags[k] IN ('B', 'S') THEN '/' ELSE '' END || tokens[k]), ''), '') AS words
      FROM best""",
    "dictionary_build": f"""WITH {_SEGMENTED}, fresh AS (SELECT word FROM segmented EXCEPT SELECT word FROM lexicon_freq), {_reading('fresh')}, {_HEAD},
      body AS (SELECT word, readings, line_no AS k FROM lexicon_freq UNION ALL SELECT word, [reading], NULL FROM read WHERE reading IS NOT NULL)
      SELECT word, row_number() OVER (ORDER BY k NULLS LAST, word) + {lex.FIRST_ID - 1} AS id,
        coalesce(array_to_string(list_transform(readings, lambda r: array_to_string(list_transform(string_split(r, ''''), lambda p: {_normal('p')}), '''')), ' '), '') AS readings
      FROM body UNION ALL SELECT word, id, '' FROM head""",
    "lexicon_lines": f"""WITH {_values(LEXICON_LINES, 'lines', 'line_no, line')},
      f AS (SELECT line_no, regexp_split_to_array(trim(line), '\\s+') AS f FROM lines WHERE trim(line) <> '')
      SELECT line_no, f[1] AS word, array_to_string(f[2:len(f) - 1], ' ') AS readings, TRY_CAST(f[len(f)] AS BIGINT) AS freq FROM f""",
    "affix_lines": f"""WITH {_values(AFFIX_LINES, 'lines', 'line_no, line')},
      f AS (SELECT regexp_split_to_array(trim(line), '\\s+') AS f FROM lines WHERE trim(line) <> '' AND NOT starts_with(line, '#')),
      affixes AS (SELECT f[1] AS affix, TRY_CAST(f[2] AS INTEGER) AS flag FROM f),
      {_STORE}
      SELECT DISTINCT word FROM store, affixes WHERE flag = 1 AND right(word, 1) = affix OR flag = 0 AND left(word, 1) = affix""",
    "stroke_lines": f"""WITH {_values(STROKE_LINES, 'lines', 'line_no, line')}
      SELECT split_part(trim(line), ' ', 1) AS ch, TRY_CAST(split_part(trim(line), ' ', 2) AS INTEGER) AS strokes FROM lines WHERE len(string_split(trim(line), ' ')) = 2""",
    "unihan_lines": f"""WITH {_values(UNIHAN_LINES, 'lines', 'line_no, line')}
      SELECT line_no, split_part(line, chr(9), 1) AS cp, split_part(line, chr(9), 2) AS prop, split_part(line, chr(9), 3) AS value FROM lines
      WHERE regexp_matches(line, '^U\\+[0-9A-F]+\t[^\t]*\t[^\t]*$')""",
    "rank_lines": f"""WITH {_values(RANK_LINES, 'lines', 'file, line_no, line')},
      numbered AS (SELECT split_part(trim(line), ' ', 1) AS word, row_number() OVER (ORDER BY file, line_no) - 1 AS rank FROM lines)
      SELECT word, max(rank) AS rank FROM numbered GROUP BY word""",
    "token_blocks": f"""WITH {_values(BLOCK_LINES, 'lines', 'line_no, line')},
      marked AS (SELECT *, line = '' OR line[1] IN (' ', chr(9)) AS ends, sum(CASE WHEN line = '' OR line[1] IN (' ', chr(9)) THEN 1 ELSE 0 END) OVER (ORDER BY line_no) AS block FROM lines)
      SELECT CAST(block AS BIGINT) AS block, count(*) AS n_tokens, string_agg(regexp_replace(trim(line), '[ \t]+', '|', 'g'), ' ' ORDER BY line_no) AS rows
      FROM marked WHERE NOT ends GROUP BY block""",
    "field_split": f"""WITH {_values([(k, v) for k, v in enumerate(FIELD_LINES)], 'lines', 'line_no, line')}
      SELECT line_no, len(regexp_split_to_array(line, '[ \t]')) AS n_each, len(list_filter(regexp_split_to_array(line, '[ \t]+'), lambda f: f <> '')) AS n_runs FROM lines""",
    "cedict_store": f"""WITH {_values(CEDICT, 'cedict', 'line_no, line')},
      parsed AS (SELECT regexp_extract(line, '^\\S+ (\\S+) \\[([^\\]]+)\\]', 1) AS word, string_split(regexp_extract(line, '^\\S+ (\\S+) \\[([^\\]]+)\\]', 2), ' ') AS ps
        FROM cedict WHERE NOT starts_with(line, '#'))
      SELECT DISTINCT word, CAST(1 AS BIGINT) AS freq FROM parsed WHERE word <> '' AND len(list_filter(ps, lambda p: NOT regexp_matches(p, '[1-5]$'))) = 0""",
    "hit_query_url": "SELECT DISTINCT word, 'http://www.baidu.com/s?wd=' || url_encode(word) AS url FROM lexicon_freq WHERE word IS NOT NULL",
    "extract_with_model": f"""WITH RECURSIVE {_TOKENS}, {_paths()}, {_STORE},
      joined AS (SELECT coalesce(array_to_string(list_transform(range(1, len(tokens)), lambda k: CASE WHEN k > 1 AND tags[k] IN ('B', 'S') THEN chr(31) ELSE '' END || tokens[k]), ''), '') AS ws FROM best),
      found AS (SELECT DISTINCT unnest(string_split(ws, chr(31))) AS word FROM joined WHERE ws <> '')
      SELECT word, freq FROM found JOIN store USING (word) WHERE {_KILL} IS NULL AND freq > {KEEP_ABOVE} AND word NOT IN (SELECT word FROM lexicon_freq WHERE word IS NOT NULL)""",
}
