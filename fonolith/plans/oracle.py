"""The queries over the speech tables in DuckDB's SQL."""

from __future__ import annotations

from fonolith.schema import DECIMALS, GENERATOR, OTHER_WEIGHT, UNIT_TO_VISEME, VISEMES, WEIGHTS

# The same characters as fonolith.functions.text.BLANK, as RE2 writes them.
_B = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_B}+|{_B}+$', '', 'g')"


def _norm(x: str) -> str:
    t = f"translate(lower({_strip(x)}), '’`áéíóú', '''''aeiou')"
    return f"regexp_replace(regexp_replace({t}, '^[^a-z0-9ñü]+|[^a-z0-9ñü]+$', '', 'g'), '[^a-z0-9ñü''-]+', '', 'g')"


def _norm_text(x: str) -> str:
    t = f"translate(coalesce({x}, ''), '“”‘’—–', '\"\"''''--')"
    return rf"regexp_replace(regexp_replace({t}, '{_B}+', ' ', 'g'), '^[ \-.,;:]+|[ \-.,;:]+$', '', 'g')"


def _sec(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN round(greatest(0::DOUBLE, {x}::DOUBLE / 1000::DOUBLE) + 1e-9, 3) END"


def _clock(x: str) -> str:
    return f"printf('%.3f', {_sec(x)})"


def _clock0(x: str) -> str:
    return f"coalesce({_clock(x)}, 'null')"


def _words_text(words: str) -> str:
    each = f"list_transform({words}, lambda w: w.word || ' ' || {_clock0('w.start_ms')} || ' ' || {_clock0('w.end_ms')})"
    return f"coalesce(array_to_string({each}, ', '), '')"


def _join(tokens: str) -> str:
    """A list of tokens as running text."""
    full = f"list_filter(list_transform({tokens}, lambda w: {_strip("coalesce(w, '')")}), lambda w: w <> '')"
    glue = "w[1] IN ('.', ',', '!', '?', ';', ':', ')', ']', '}') OR f[i - 1][-1] IN ('(', '[', '{', '\"', '''')"
    return f"(SELECT coalesce(array_to_string(list_transform(f, lambda w, i: CASE WHEN i = 1 OR {glue} THEN w ELSE ' ' || w END), ''), '') FROM (SELECT {full} AS f))"


_WORDS = r"""
tok AS (SELECT conv_id AS audio_id, turn AS seg, list_filter(string_split_regex(text, '[ \t\r\n]+'), lambda t: t <> '') AS toks FROM conversations),
one AS (SELECT audio_id, seg, i - 1 AS wi, toks[i] AS word FROM (SELECT *, unnest(range(1, len(toks) + 1)) AS i FROM tok)),
beat AS (SELECT *, (seg * 31 + wi * 7) AS b, 80 + 45 * least(length(word), 12) AS d FROM one),
ended AS (SELECT *, CAST(sum(CASE WHEN b % 11 = 0 THEN 300 WHEN b % 5 = 0 THEN 40 ELSE 0 END + d) OVER (PARTITION BY audio_id ORDER BY seg, wi) AS BIGINT) AS end_ms FROM beat),
words AS (SELECT audio_id, seg, wi, row_number() OVER (PARTITION BY audio_id ORDER BY seg, wi) - 1 AS word_idx, word, end_ms - d AS start_ms, end_ms FROM ended)"""

_RAW = """
raw AS (SELECT audio_id, word_idx, CASE WHEN word_idx % 31 = 7 THEN ' ' WHEN word_idx % 17 = 3 THEN ' ' || word ELSE word END AS word,
          CASE WHEN word_idx % 23 <> 5 THEN start_ms END AS start_ms,
          CASE WHEN word_idx % 37 = 11 THEN NULL WHEN word_idx % 29 = 2 THEN start_ms ELSE end_ms END AS end_ms FROM words)"""

_VALID = f"""
valid AS (SELECT audio_id, row_number() OVER (PARTITION BY audio_id ORDER BY start_ms, end_ms, word_idx) - 1 AS word_idx, {_strip("word")} AS word, start_ms, end_ms
          FROM raw WHERE {_strip("word")} <> '' AND end_ms > start_ms)"""

_SEGMENTS = """
seg AS (SELECT w.audio_id, w.seg, any_value(c.text) AS text, min(start_ms) AS start_ms,
          CASE WHEN (w.audio_id * 7 + w.seg) % 17 = 0 THEN NULL WHEN (w.audio_id + w.seg * 5) % 19 = 0 THEN min(start_ms) ELSE max(end_ms) END AS end_ms,
          CASE WHEN (w.audio_id + w.seg) % 13 = 0 THEN [] ELSE list({'word': word, 'start_ms': start_ms, 'end_ms': end_ms} ORDER BY wi) END AS words
        FROM words w JOIN conversations c ON c.conv_id = w.audio_id AND c.turn = w.seg GROUP BY w.audio_id, w.seg)"""


def _reason(text: str = "text", shortest: int = 400, longest: int | None = None) -> str:
    long_ = f" WHEN end_ms - start_ms > {longest} THEN 'too long'" if longest else ""
    return (
        f"CASE WHEN start_ms IS NULL OR end_ms IS NULL THEN 'missing timestamps' WHEN end_ms <= start_ms THEN 'end <= start' "
        f"WHEN {_strip(f"coalesce({text}, '')")} = '' THEN 'empty text' WHEN end_ms - start_ms < {shortest} THEN 'too short'{long_} END"
    )


_UNIT_CASES = r"""CASE
  WHEN t LIKE 'gü%' THEN ['g', 'u', right(t, 1)]
  WHEN t IN ('ch', 'll', 'rr') THEN [t]
  WHEN t IN ('que', 'qui') THEN ['k', right(t, 1)] WHEN t = 'qu' THEN ['k']
  WHEN t IN ('gue', 'gui') THEN ['g', right(t, 1)] WHEN t = 'gu' THEN ['g']
  WHEN t IN ('ge', 'gi') THEN ['j', right(t, 1)] WHEN t IN ('ce', 'ci') THEN ['s', right(t, 1)]
  WHEN t = 'g' AND i = len(toks) THEN ['j'] WHEN t = 'c' AND i = len(toks) THEN ['s'] WHEN t = 'y' AND i = len(toks) THEN ['i']
  WHEN regexp_full_match(t, '[h''0-9-]') THEN CAST([] AS VARCHAR[])
  WHEN t IN ('b', 'v') THEN ['b'] WHEN t IN ('q', 'c') THEN ['k'] WHEN t IN ('z', 's', 'x') THEN ['s']
  WHEN t = 'ñ' THEN ['ny'] WHEN t IN ('w', 'ü') THEN ['u'] ELSE [t] END"""

_UNITS = f"""
norm AS (SELECT *, {_norm("word")} AS norm FROM words),
cut AS (SELECT *, regexp_extract_all(norm, 'gü[ei]|ch|ll|rr|qu(?:[ei]|$)|gu(?:[ei]|$)|g(?:[ei]|$)|c(?:[ei]|$)|y$|.') AS toks FROM norm),
unit AS (SELECT *, flatten(list_transform(toks, lambda t, i: {_UNIT_CASES})) AS units FROM cut)"""

_MAP = " ".join(f"WHEN u = '{u}' THEN '{v}'" for u, v in UNIT_TO_VISEME.items())
_VIS = f"""
vis AS (SELECT *, CASE WHEN len(units) = 0 THEN ['SIL'] ELSE list_transform(units, lambda u: CASE {_MAP} ELSE 'TD' END) END AS vis FROM unit)"""

_WEIGHT = "CASE " + " ".join(f"WHEN viseme = '{v}' THEN {w}" for v, w in WEIGHTS.items()) + f" ELSE {OTHER_WEIGHT} END"
_DEALT = f"""
shape AS (SELECT audio_id, word_idx, start_ms, end_ms, k, vis[k] AS viseme FROM (SELECT *, unnest(range(1, len(vis) + 1)) AS k FROM vis WHERE norm <> '' AND end_ms > start_ms)),
heavy AS (SELECT *, {_WEIGHT} AS w FROM shape),
share AS (SELECT *, CAST(sum(w) OVER (PARTITION BY audio_id, word_idx ORDER BY k) AS BIGINT) AS c, CAST(sum(w) OVER (PARTITION BY audio_id, word_idx) AS BIGINT) AS total,
            CASE WHEN lag(viseme) OVER (PARTITION BY audio_id, word_idx ORDER BY k) = viseme THEN 0 ELSE 1 END AS head FROM heavy)"""


def _dealt(merged: bool) -> str:
    """Spans of words: (audio_id, word_idx, span_idx, viseme, start_ms, end_ms)."""
    island = "sum(head) OVER (PARTITION BY audio_id, word_idx ORDER BY k)" if merged else "k"
    return f"""{_DEALT},
runs AS (SELECT *, {island} AS run FROM share),
ends AS (SELECT audio_id, word_idx, run, any_value(viseme) AS viseme, any_value(start_ms) AS s, any_value(end_ms) AS e, min(c - w) AS c0, max(c) AS c1, any_value(total) AS total FROM runs GROUP BY audio_id, word_idx, run),
spans AS (SELECT audio_id, word_idx, CAST(run - 1 AS BIGINT) AS span_idx, viseme, s + (e - s) * c0 / total AS start_ms, CASE WHEN c1 = total THEN e::DOUBLE ELSE s + (e - s) * c1 / total END AS end_ms FROM ends)"""


def _merge(source: str, to: str) -> str:
    w = "PARTITION BY audio_id ORDER BY start_ms, end_ms, seq"
    return f"""
{to}_a AS (SELECT *, max(end_ms) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {source} WHERE end_ms > start_ms),
{to}_b AS (SELECT * FROM {to}_a WHERE reach IS NULL OR end_ms > reach),
{to}_c AS (SELECT *, CASE WHEN reach IS NULL OR viseme <> lag(viseme) OVER ({w}) OR start_ms > reach + 1 THEN 1 ELSE 0 END AS opens FROM {to}_b),
{to}_d AS (SELECT *, sum(opens) OVER ({w}) AS island FROM {to}_c),
{to} AS (SELECT audio_id, CAST(island - 1 AS BIGINT) AS idx, any_value(viseme) AS viseme, min(greatest(start_ms, coalesce(reach, start_ms))) AS start_ms, max(end_ms) AS end_ms FROM {to}_d GROUP BY audio_id, island)"""


def _timeline(silence: bool, threshold: int = 60) -> str:
    w = "PARTITION BY audio_id ORDER BY start_ms, end_ms, seq"
    sil = f"SELECT audio_id, 'SIL' AS viseme, cursor AS start_ms, start_ms AS end_ms, place * 2 AS seq FROM cur WHERE start_ms - cursor >= {threshold} UNION ALL" if silence else ""
    return f"""{_WORDS}, {_UNITS}, {_VIS}, {_dealt(True)},
seqd AS (SELECT audio_id, word_idx * 1024 + span_idx AS seq, viseme, start_ms, end_ms FROM spans),
cur AS (SELECT *, row_number() OVER ({w}) AS place, greatest(0::DOUBLE, coalesce(max(end_ms) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS cursor FROM seqd),
both_ AS ({sil} SELECT audio_id, viseme, greatest(start_ms, cursor) AS start_ms, end_ms, place * 2 + 1 AS seq FROM cur),
{_merge("both_", "line")}"""


_SPAN_ROWS = f"viseme, {_sec('start_ms')} AS start, {_sec('end_ms')} AS \"end\""

_PREFIX = r"""
stem AS (SELECT conv_id AS audio_id, translate(left(arg_min(text, turn), 6), '/.' || chr(10), '---') || '_' || conv_id AS stem FROM conversations GROUP BY conv_id),
clean AS (SELECT audio_id, lower(regexp_replace(strip_accents(stem), '[^A-Za-z0-9]', '', 'g')) AS c FROM stem),
prefixes AS (SELECT audio_id, CASE WHEN c = '' THEN 'audx' ELSE rpad(left(c, 4), 4, 'x') END AS prefix FROM clean)"""

_LISTING = r"""
listing AS (SELECT rpad(lower(regexp_replace(p_name, '[^A-Za-z0-9]', '', 'g')), 4, 'x') AS prefix, p_partkey % 7 <> 0 AS is_file,
              CASE WHEN p_partkey % 10 = 0 THEN right(lpad(p_partkey::VARCHAR, 6, '0'), 5) ELSE lpad(p_partkey::VARCHAR, 6, '0') END AS digits FROM part),
suffix AS (SELECT prefix, coalesce(max(CASE WHEN is_file AND length(digits) = 6 THEN digits::INT END), 0) AS max_idx FROM listing GROUP BY prefix)"""

_CLIPS = f"""{_WORDS}, {_SEGMENTS}, {_PREFIX}, {_LISTING},
kept AS (SELECT *, {_reason()} AS reason FROM seg),
named AS (SELECT audio_id, seg, text, prefix, row_number() OVER (PARTITION BY prefix ORDER BY audio_id, seg) + coalesce(max_idx, 0) AS clip_idx
          FROM (SELECT * FROM kept WHERE reason IS NULL) JOIN prefixes USING (audio_id) LEFT JOIN suffix USING (prefix)),
clips AS (SELECT *, printf('%s_%06d.wav', prefix, clip_idx) AS filename FROM named)"""

_TEXT_OF = _join("list_transform(ws, lambda x: x.word)")

_PHRASES = rf"""{_WORDS}, {_SEGMENTS},
sw AS (SELECT audio_id, seg, i - 1 AS wi, words[i] AS w FROM (SELECT *, unnest(range(1, len(words) + 1)) AS i FROM seg)),
fin AS (SELECT *, CASE WHEN regexp_matches({_strip("w.word")}, '[.!?]+["'')\]]*$') THEN 1 ELSE 0 END AS fin FROM sw),
num AS (SELECT *, coalesce(sum(fin) OVER (PARTITION BY audio_id ORDER BY seg, wi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n FROM fin),
spoken AS (SELECT audio_id, CASE WHEN max(fin) = 1 THEN max(seg * 100000 + wi) ELSE 4611686018427387904 END AS place, list(w ORDER BY seg, wi) AS ws FROM num GROUP BY audio_id, n),
ph AS (SELECT audio_id, place, ws[1].start_ms AS start_ms, ws[-1].end_ms AS end_ms, {_TEXT_OF} AS text, ws FROM spoken
       UNION ALL SELECT audio_id, seg * 100000 - 1, start_ms, end_ms, {_strip("text")}, words FROM seg WHERE len(words) = 0 AND {_strip("coalesce(text, '')")} <> ''),
raw_ph AS (SELECT *, row_number() OVER (PARTITION BY audio_id ORDER BY place) AS phrase_idx FROM ph)"""

_SPLIT = f"""{_PHRASES},
long_ AS (SELECT audio_id, phrase_idx, ws FROM raw_ph WHERE len(ws) > 0 AND end_ms - start_ms > 7000),
fold AS (SELECT audio_id, phrase_idx, ws, 1 AS i, 0 AS part, ws[1].start_ms AS s0, 1 AS n FROM long_
         UNION ALL
         SELECT audio_id, phrase_idx, ws, i + 1, CASE WHEN ws[i + 1].end_ms - s0 >= 7000 AND n >= 1 THEN part + 1 ELSE part END,
           CASE WHEN ws[i + 1].end_ms - s0 >= 7000 AND n >= 1 THEN ws[i + 1].start_ms ELSE s0 END, CASE WHEN ws[i + 1].end_ms - s0 >= 7000 AND n >= 1 THEN 1 ELSE n + 1 END
         FROM fold WHERE i < len(ws)),
chunk AS (SELECT audio_id, phrase_idx, part, list(ws[i] ORDER BY i) AS ws FROM fold GROUP BY audio_id, phrase_idx, part),
pieces AS (SELECT audio_id, phrase_idx, part, ws[1].start_ms AS start_ms, ws[-1].end_ms AS end_ms, {_TEXT_OF} AS text, ws FROM chunk
           UNION ALL SELECT audio_id, phrase_idx, 0, start_ms, end_ms, text, ws FROM raw_ph WHERE NOT (len(ws) > 0 AND coalesce(end_ms - start_ms > 7000, false))),
split_ph AS (SELECT audio_id, row_number() OVER (PARTITION BY audio_id ORDER BY phrase_idx, part) AS phrase_idx, start_ms, end_ms, text, ws FROM pieces)"""

_NORM = f"""{_SPLIT},
gfold AS (SELECT audio_id, phrase_idx, 1 AS grp, start_ms AS s0, end_ms AS e0 FROM split_ph WHERE phrase_idx = 1
          UNION ALL
          SELECT p.audio_id, p.phrase_idx, CASE WHEN greatest(0, coalesce(e0 - s0, 0)) >= 1500 THEN grp + 1 ELSE grp END,
            CASE WHEN greatest(0, coalesce(e0 - s0, 0)) >= 1500 THEN p.start_ms ELSE s0 END, p.end_ms
          FROM gfold g JOIN split_ph p ON p.audio_id = g.audio_id AND p.phrase_idx = g.phrase_idx + 1),
joined AS (SELECT p.audio_id, grp AS phrase_idx, arg_min(p.start_ms, p.phrase_idx) AS s, list(p.end_ms ORDER BY p.phrase_idx)[-1] AS e, list(p.start_ms ORDER BY p.phrase_idx)[1] AS s1,
             coalesce(string_agg(nullif({_strip("text")}, ''), ' ' ORDER BY p.phrase_idx), '') AS t, flatten(list(ws ORDER BY p.phrase_idx)) AS ws
           FROM split_ph p JOIN gfold g USING (audio_id, phrase_idx) GROUP BY p.audio_id, grp),
norm_ph AS (SELECT audio_id, phrase_idx, CASE WHEN len(ws) > 0 THEN ws[1].start_ms ELSE s1 END AS start_ms, CASE WHEN len(ws) > 0 THEN ws[-1].end_ms ELSE e END AS end_ms,
              CASE WHEN len(ws) > 0 THEN {_TEXT_OF} ELSE t END AS text, ws FROM joined)"""


def _phrase_rows(with_: str, name: str) -> str:
    return f"WITH RECURSIVE {with_} SELECT audio_id, CAST(phrase_idx AS BIGINT) AS phrase_idx, {_sec('start_ms')} AS start, {_sec('end_ms')} AS \"end\", text, CAST(len(ws) AS INT) AS n_words FROM {name}"


_TOKENS = r"""string_split_regex(regexp_replace(regexp_replace(text, '([.,!?;:()])', ' \1 ', 'g'), '''', ' " ', 'g'), '[ \n]')"""

SQL = {
    "normalize_word": f"WITH {_WORDS} SELECT audio_id, word_idx, {_norm('word')} AS norm FROM words",
    "normalize_text": f"SELECT conv_id, turn, {_norm_text('text')} AS norm_text FROM conversations",
    "g2p_units": f"WITH {_WORDS}, {_UNITS} SELECT audio_id, word_idx, coalesce(array_to_string(units, ' '), '') AS units FROM unit",
    "visemes": f"WITH {_WORDS}, {_UNITS}, {_VIS} SELECT audio_id, word_idx, array_to_string(vis, ' ') AS visemes FROM vis",
    "distribute": f"WITH {_WORDS}, {_UNITS}, {_VIS}, {_dealt(False)} SELECT audio_id, word_idx, CAST(span_idx AS INT) AS span_idx, {_SPAN_ROWS} FROM spans",
    "merge_word_spans": f"WITH {_WORDS}, {_UNITS}, {_VIS}, {_dealt(True)} SELECT audio_id, word_idx, CAST(span_idx AS INT) AS span_idx, {_SPAN_ROWS} FROM spans",
    "merge_overlapping": f"""WITH us AS (SELECT *, epoch_us(ts) - min(epoch_us(ts)) OVER () AS u FROM events),
ov AS (SELECT user_id AS audio_id, event_id AS seq, event_type AS viseme, u // 1000 AS start_ms, u // 1000 + CAST(round(value * 100) AS BIGINT) * 3000 AS end_ms FROM us),
{_merge("ov", "line")} SELECT audio_id, idx, {_SPAN_ROWS} FROM line""",
    "timeline_sil": f"WITH {_timeline(True)} SELECT audio_id, idx, {_SPAN_ROWS} FROM line",
    "timeline_nosil": f"WITH {_timeline(False)} SELECT audio_id, idx, {_SPAN_ROWS} FROM line",
    "mouth_cues": f"WITH {_timeline(True)} SELECT audio_id, idx AS cue_idx, viseme AS value, {_sec('start_ms')} AS start, {_sec('end_ms')} AS \"end\" FROM line",
    "main_words": f"""WITH {_WORDS}, {_UNITS}, {_VIS}, {_dealt(True)},
texts AS (SELECT audio_id, word_idx, string_agg(viseme || ' ' || {_clock("start_ms")} || ' ' || {_clock("end_ms")}, ', ' ORDER BY span_idx) AS visemes FROM spans GROUP BY audio_id, word_idx)
SELECT audio_id, word_idx, norm AS word, {_sec("start_ms")} AS start, {_sec("end_ms")} AS "end", visemes FROM norm JOIN texts USING (audio_id, word_idx)""",
    "main_payload": f"""WITH {_timeline(True)}, {_SEGMENTS}, {_PREFIX},
texts AS (SELECT audio_id, word_idx, string_agg(viseme || ' ' || {_clock("start_ms")} || ' ' || {_clock("end_ms")}, ', ' ORDER BY span_idx) AS t FROM spans GROUP BY audio_id, word_idx),
by_word AS (SELECT audio_id, string_agg(norm || ' ' || {_clock("start_ms")} || ' ' || {_clock("end_ms")} || ' [' || t || ']', '; ' ORDER BY word_idx) AS words FROM norm JOIN texts USING (audio_id, word_idx) GROUP BY audio_id),
by_line AS (SELECT audio_id, string_agg(viseme || ' ' || {_clock("start_ms")} || ' ' || {_clock("end_ms")}, ', ' ORDER BY idx) AS timeline FROM line GROUP BY audio_id),
said AS (SELECT audio_id, string_agg({_strip("text")}, ' ' ORDER BY seg) AS transcript FROM seg WHERE {_strip("text")} <> '' GROUP BY audio_id)
SELECT audio_id, '{GENERATOR}|{DECIMALS}|{" ".join(VISEMES)}|base' AS head, 'audio/' || stem || '.mp3' AS audio_file, 'es' AS language, transcript, words, timeline
FROM by_word JOIN by_line USING (audio_id) JOIN said USING (audio_id) JOIN stem USING (audio_id)""",
    "mouth_cue_payload": f"WITH {_timeline(True)} SELECT audio_id, string_agg(viseme || ' ' || {_clock('start_ms')} || ' ' || {_clock('end_ms')}, ', ' ORDER BY idx) AS cues FROM line GROUP BY audio_id",
    "transcript_document": f"""WITH RECURSIVE {_NORM}, {_PREFIX},
by_seg AS (SELECT audio_id, string_agg(seg || ' ' || {_clock0("start_ms")} || ' ' || {_clock0("end_ms")} || ' ' || {_strip("text")} || ' [' || {_words_text("words")} || ']', '; ' ORDER BY seg) AS segments,
             string_agg(nullif({_strip("text")}, ''), ' ' ORDER BY seg) AS text FROM seg GROUP BY audio_id),
by_phrase AS (SELECT audio_id, string_agg({_clock0("start_ms")} || ' ' || {_clock0("end_ms")} || ' ' || {_strip("text")} || ' [' || {_words_text("ws")} || ']', '; ' ORDER BY phrase_idx) AS phrases FROM norm_ph GROUP BY audio_id)
SELECT audio_id, 'audio/' || stem || '.mp3' AS audio_file, 'large-v3' AS model, 'es' AS language, coalesce(text, '') AS text, segments, coalesce(phrases, '') AS phrases
FROM by_seg LEFT JOIN by_phrase USING (audio_id) JOIN stem USING (audio_id)""",
    "transcript_rows": f"""WITH {_WORDS}, {_SEGMENTS}, {_PREFIX}
SELECT 'audio/' || stem || '.mp3' AS audio_file, row_number() OVER (PARTITION BY audio_id ORDER BY seg) - 1 AS seg, {_strip("text")} AS text, {_sec("start_ms")} AS start, {_sec("end_ms")} AS "end", {_words_text("words")} AS words
FROM seg JOIN stem USING (audio_id)""",
    "rejected_documents": f"""WITH {_WORDS}, {_SEGMENTS}, {_PREFIX}
SELECT audio_id || '.json' AS document, CASE audio_id % 5 WHEN 1 THEN 'no JSON' WHEN 2 THEN 'nothing in it' ELSE 'no field of a transcript' END AS reason FROM (SELECT DISTINCT audio_id FROM seg JOIN stem USING (audio_id)) WHERE audio_id % 5 IN (1, 2, 3)""",
    "recording_status": f"""WITH {_WORDS}, {_RAW}, kept AS (SELECT audio_id, CASE WHEN audio_id % 5 = 2 THEN '' ELSE {_norm("word")} END AS norm FROM raw WHERE audio_id % 5 <> 1 AND ({_strip("word")} <> '' OR audio_id % 5 = 2) AND end_ms > start_ms)
SELECT audio_id, CASE WHEN count(norm) = 0 THEN 'no word timestamps' WHEN count(nullif(norm, '')) = 0 THEN 'no usable words' ELSE 'ok' END AS status FROM (SELECT DISTINCT audio_id FROM words) LEFT JOIN kept USING (audio_id) GROUP BY audio_id""",
    "timeline_clamped": f"WITH {_timeline(True, 0)} SELECT audio_id, idx, {_SPAN_ROWS} FROM line",
    "viseme_stats": f"WITH {_timeline(True)} SELECT viseme, count(*) AS n_spans, CAST(sum(CAST(floor((end_ms - start_ms) * 1000 + 0.5) AS BIGINT)) AS BIGINT) AS total_us FROM line GROUP BY viseme",
    "valid_words": f"WITH {_WORDS}, {_RAW}, {_VALID} SELECT audio_id, word_idx, word, {_sec('start_ms')} AS start, {_sec('end_ms')} AS \"end\" FROM valid",
    "transcript_text": f"""WITH {_WORDS}, {_RAW}, {_VALID}, {_SEGMENTS},
st AS (SELECT audio_id, seg, CASE WHEN audio_id % 9 = 4 OR seg % 3 = 2 THEN '' ELSE {_strip("text")} END AS t FROM seg),
a AS (SELECT audio_id, string_agg(t, ' ' ORDER BY seg) AS t FROM st WHERE t <> '' GROUP BY audio_id),
b AS (SELECT audio_id, string_agg(word, ' ' ORDER BY word_idx) AS t FROM valid WHERE word <> '' GROUP BY audio_id)
SELECT audio_id, coalesce(a.t, b.t, '') AS transcript FROM b FULL JOIN a USING (audio_id)""",
    "segment_cascade": f"WITH {_WORDS}, {_SEGMENTS}, x AS (SELECT audio_id, seg, start_ms, end_ms, CASE WHEN (audio_id + seg) % 11 = 3 THEN ' ' ELSE text END AS text FROM seg) SELECT audio_id, seg, {_reason('text', 900, 60_000)} AS skip_reason FROM x",
    "build_summary": f"""WITH {_WORDS}, {_SEGMENTS}, x AS (SELECT audio_id, {_reason()} AS r FROM seg)
SELECT audio_id, count(*) AS total_segments, count(*) - count(r) AS exported_segments, count(r) AS skipped_segments FROM x GROUP BY audio_id""",
    "cut_list": f"""WITH {_WORDS}, {_SEGMENTS}, x AS (SELECT *, {_reason()} AS r FROM seg),
y AS (SELECT audio_id, seg, CASE WHEN len(words) > 0 THEN words[1].start_ms ELSE start_ms END AS s, CASE WHEN len(words) > 0 THEN words[-1].end_ms ELSE end_ms END AS e FROM x WHERE r IS NULL)
SELECT audio_id, seg, {_clock("s")} AS cut_start, {_clock("greatest(0, e + 250 - s)")} AS cut_duration FROM y""",
    "clip_names": f"WITH {_CLIPS} SELECT audio_id, seg, prefix, clip_idx, filename FROM clips",
    "metadata_classic": f"WITH {_CLIPS} SELECT filename, {_strip('text')} AS raw_text, {_norm_text(_strip('text'))} AS norm_text FROM clips",
    "metadata_piper": f"WITH {_CLIPS} SELECT filename, {_norm_text(_strip('text'))} AS norm_text FROM clips",
    "phrases_raw": _phrase_rows(_PHRASES, "raw_ph"),
    "phrases_split": _phrase_rows(_SPLIT, "split_ph"),
    "phrases_norm": _phrase_rows(_NORM, "norm_ph"),
    "phrase_text": f"SELECT conv_id, turn, {_join('toks')} AS phrase FROM (SELECT conv_id, turn, {_TOKENS} AS toks FROM conversations)",
    "audio_prefix": f"WITH {_PREFIX} SELECT audio_id, prefix FROM prefixes",
    "max_suffix": f"WITH {_LISTING} SELECT prefix, max_idx FROM suffix",
    "language_default": "SELECT doc_id, lower(coalesce(nullif(CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN '' ELSE upper(lang) END, ''), 'es')) AS language FROM documents",
}
