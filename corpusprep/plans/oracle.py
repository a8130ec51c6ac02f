"""The same results as :mod:`corpusprep.plans.catalog`, in SQL for an independent engine."""

from __future__ import annotations

from corpusprep.functions.text import WHITESPACE_CODES
from corpusprep.functions.tokenizers import NativeTokenizer
from corpusprep.operators import pairs, scoring
from corpusprep.plans import catalog
from corpusprep.sources.templates import NO_RESPONSE

WS = "concat(" + ", ".join(f"chr({c})" for c in WHITESPACE_CODES) + ")"
PIECE = NativeTokenizer.PATTERN
NL = "chr(10)"
SCRIPT = "[À-ÿ]"
CATEGORY = (
    "CASE language " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in catalog.CATEGORY_OF_LANGUAGE.items()) + " ELSE 'english_retention' END"
)


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, '{PIECE}')"


def hash_of(*parts: str) -> str:
    return "sha256(concat('42:', " + ", ':', ".join(parts) + "))"


def hash_index(h: str, size: str) -> str:
    return f"(('0x' || substr({h}, 1, 15))::BIGINT % {size})"


SFT = f"""sft AS (
  SELECT doc_id, lang AS language, source,
         split_part(text, {NL}, 1) AS instruction,
         CASE WHEN strpos(text, {NL}) > 0 THEN substr(text, strpos(text, {NL}) + 1) ELSE '' END AS input,
         split_part(text, {NL}, -1) AS output
  FROM documents)"""
EARLY = f"CASE WHEN length({strip('instruction')}) < 3 OR length({strip('output')}) < 2 THEN 'empty_fields' END"
DIGEST = "sha256(concat(instruction, chr(0), output))"
PROMPT = strip("concat(instruction, ' ', input)")


def length_class(n: str, max_tokens: int) -> str:
    return f"CASE WHEN {n} <= {max_tokens * 2} THEN 'valid' WHEN {n} > {max_tokens * 5} THEN 'too_long' ELSE 'borderline' END"


def classified(length_state: str, prompt: str = PROMPT) -> str:
    return f"""WITH {SFT},
early AS (SELECT *, {EARLY} AS early FROM sft),
ranked AS (
  SELECT *, {prompt} AS prompt,
         row_number() OVER (PARTITION BY early IS NULL, {DIGEST} ORDER BY doc_id) AS nth
  FROM early),
staged AS (
  SELECT *, CASE WHEN early IS NOT NULL THEN early WHEN nth > 1 THEN 'duplicates' ELSE {length_state} END AS stage
  FROM ranked),
counted AS (
  SELECT *, CASE WHEN stage = 'borderline' THEN len({tokens('prompt')}) END AS n_tokens FROM staged),
judged AS (
  SELECT doc_id, language, source, n_tokens,
         CASE WHEN stage <> 'borderline' THEN stage WHEN n_tokens <= 1024 THEN 'valid' ELSE 'too_long' END AS status
  FROM counted)"""


JUDGED = classified(length_class("length(prompt)", 1024))
STATUS_SUMS = ", ".join(
    f"CAST(count(*) FILTER (status = '{s}') AS BIGINT) AS {s}"
    for s in ("malformed", "empty_fields", "duplicates", "valid", "too_long")
)
SPLIT = f"""{JUDGED},
parts AS (
  SELECT doc_id, language,
         CASE WHEN r <= floor(n * 0.8::DOUBLE) THEN 'train' WHEN r <= floor(n * 0.9::DOUBLE) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY {hash_of('doc_id')}) AS r, count(*) OVER () AS n
        FROM judged WHERE status = 'valid'))"""
LINES = f"""lines AS (
  SELECT doc_id, lang, line_no, {strip('line')} AS line FROM (
    SELECT doc_id, lang, unnest(pieces) AS line, unnest(range(len(pieces))) AS line_no
    FROM (SELECT doc_id, lang, string_split(text, {NL}) AS pieces FROM documents)))"""
LCPT = f"""{LINES},
lcpt AS (
  SELECT doc_id, line_no, n_chars, n_tokens,
         CASE WHEN stage <> 'borderline' THEN stage WHEN n_tokens <= 2048 THEN 'valid' ELSE 'too_long' END AS status
  FROM (SELECT *, CASE WHEN stage = 'borderline' THEN len({tokens('line')}) END AS n_tokens
        FROM (SELECT *, length(line) AS n_chars, {length_class('length(line)', 2048)} AS stage
              FROM lines WHERE length(line) >= 10)))"""
TURNS = """turns AS (
  SELECT * FROM (
    SELECT conv_id, turn, role, text AS question,
           coalesce(CASE WHEN lag(role) OVER w = 'system' THEN lag(text) OVER w END, '') AS system,
           CASE WHEN lead(role) OVER w = 'assistant' THEN lead(text) OVER w END AS answer
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user')"""
FIRST_TURNS = """first_turns AS (
  SELECT conv_id, max(text) FILTER (turn = 0) AS instruction, max(text) FILTER (turn = 1) AS output
  FROM conversations WHERE turn IN (0, 1) GROUP BY conv_id)"""
PAIRS = f"""pairs AS (
  SELECT conv_id, turn, en, hi FROM (
    SELECT conv_id, turn, role, {strip('text')} AS hi,
           lag(role) OVER w AS role_before, {strip('lag(text) OVER w')} AS en
    FROM conversations WHERE role IN ('user', 'assistant')
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'assistant' AND role_before = 'user' AND hi <> '' AND en <> '')"""
STORIES = f"SELECT * FROM pairs WHERE length(hi) BETWEEN 100 AND 8000 ORDER BY conv_id, turn LIMIT {catalog.STORY_LIMIT}"
ELIGIBLE = "SELECT * FROM pairs WHERE length(en) BETWEEN 60 AND 1500 AND length(hi) BETWEEN 60 AND 1500"
WS_RUN = f"[{''.join(chr(92) + f'x{{{c:X}}}' for c in WHITESPACE_CODES)}]+"
WORDS = f"string_split_regex(text, '{WS_RUN}')"


def script_flags(text: str = "text") -> dict[str, str]:
    words = WORDS.replace("(text,", f"({text},")
    script = f"regexp_matches({text}, '{SCRIPT}')"
    ascii_word = f"len(list_filter({words}, lambda w: w <> '' AND regexp_full_match(w, '[\\x00-\\x7F]+'))) > 0"
    return {
        "script": script,
        "mixed": f"({script} AND {ascii_word})",
        "latin": f"regexp_matches({text}, '[a-zA-Z]{{3,}}')",
    }


FLAGS = script_flags()
RESPONSE_FLAGS = script_flags("output")
SCORED = f"""WITH {SFT},
prompts AS (SELECT *, {CATEGORY} AS category FROM sft),
scored AS (
  SELECT category, doc_id AS pos, instruction AS prompt, output,
         CASE category WHEN 'hindi' THEN {RESPONSE_FLAGS['script']} WHEN 'hinglish' THEN {RESPONSE_FLAGS['mixed']}
                       ELSE {RESPONSE_FLAGS['latin']} END AS flag
  FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY doc_id) AS nth FROM prompts)
  WHERE nth <= {catalog.NUM_TESTS})"""
SYNTH = f"""WITH {SFT},
placed AS (SELECT language AS category, instruction, output,
                  row_number() OVER (PARTITION BY language ORDER BY doc_id) - 1 AS pos FROM sft),
sizes AS (SELECT category, count(*) AS t, count(*) * ({catalog.SYNTH_PER_CATEGORY} // count(*) + 1) AS made,
                 {catalog.SYNTH_PER_CATEGORY} // count(*) + 1 AS reps FROM placed GROUP BY category),
plan AS (SELECT *, sum(made) OVER (ORDER BY category) - made AS start, count(*) OVER () * {catalog.SYNTH_PER_CATEGORY} AS cap FROM sizes),
made AS (
  SELECT category, t, rep * t + pos AS idx, instruction, start, cap
  FROM (SELECT p.category, p.pos, p.instruction, plan.t, plan.start, plan.cap, unnest(range(plan.reps)) AS rep
        FROM placed p JOIN plan USING (category))),
synth AS (
  SELECT m.category, m.idx::BIGINT AS idx, m.instruction, '' AS input, coalesce(r.output, '{NO_RESPONSE}') AS output,
         CASE WHEN m.category = 'es' THEN 'hinglish' ELSE 'hindi' END AS language
  FROM made m LEFT JOIN placed r
    ON r.category = m.category AND r.pos = {hash_index(hash_of('m.category', 'm.idx'), 'm.t')}
  WHERE start + m.idx < cap)"""


def chat_text(*turns: tuple[str, str]) -> str:
    parts = [f"'<|im_start|>{role}', {NL}, {content}, '<|im_end|>', {NL}" for role, content in turns]
    return "concat(" + ", ".join(parts) + ")"


USER = strip("instruction")
ANSWER = strip("output")
CONTENT = f"CASE WHEN {strip('input')} <> '' THEN concat({USER}, {NL}, {NL}, {strip('input')}) ELSE {USER} END"
WORDINGS = "[" + ", ".join(f"'{w}'" for w in pairs.TRANSLATE_INSTRUCTIONS) + "]"
SOURCE_ROWS = f"""WITH {SFT}, {TURNS}, {FIRST_TURNS}, loaded AS (
  SELECT 'documents' AS source, false AS is_corpus FROM sft
  UNION ALL SELECT 'turns', false FROM first_turns
  UNION ALL SELECT 'answers', false FROM turns
  UNION ALL SELECT 'corpus', true FROM documents)"""

def word_list(text: str) -> str:
    return f"list_filter(string_split_regex(lower(coalesce({text}, '')), '{WS_RUN}'), lambda w: w <> '')"


def answers(rows: str) -> str:
    return f"""judged AS (
  SELECT *, said = wanted AS exact, CASE WHEN wanted = '  ' THEN said = wanted ELSE contains(said, wanted) END AS contained
  FROM (SELECT doc_id, language, ' ' || array_to_string({word_list('instruction')}, ' ') || ' ' AS said,
               ' ' || array_to_string({word_list('output')}, ' ') || ' ' AS wanted FROM {rows}))"""


def overlap(n: int, name: str = "overlap", rows: str = "sft", said: str = "instruction", wanted: str = "output") -> str:
    gram = f"CASE WHEN len(w) >= {n} THEN list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i : i + {n - 1}], ' ')) ELSE [] END"
    return f"""{name}_grams AS (
  SELECT doc_id, said, unnest({gram}) AS gram FROM (
    SELECT doc_id, true AS said, {word_list(said)} AS w FROM {rows} UNION ALL SELECT doc_id, false, {word_list(wanted)} FROM {rows})),
{name}_counts AS (
  SELECT doc_id, gram, count(*) FILTER (said) AS s, count(*) FILTER (NOT said) AS t FROM {name}_grams GROUP BY doc_id, gram),
{name} AS (
  SELECT doc_id, CAST(coalesce(sum(s), 0) AS BIGINT) AS n_candidate, CAST(coalesce(sum(t), 0) AS BIGINT) AS n_reference,
         CAST(coalesce(sum(least(s, t)), 0) AS BIGINT) AS n_common FROM {rows} LEFT JOIN {name}_counts USING (doc_id) GROUP BY doc_id)"""


def rouge(n: int) -> str:
    return f"""WITH {SFT}, {overlap(n)} SELECT *, round(coalesce(n_common / nullif(n_reference, 0)::DOUBLE, 0), 6) AS recall,
        round(coalesce(n_common / nullif(n_candidate, 0)::DOUBLE, 0), 6) AS precision,
        round(coalesce(2 * n_common / nullif(n_candidate + n_reference, 0)::DOUBLE, 0), 6) AS f1 FROM overlap"""


MIX_TOTAL = "(SELECT min(coalesce(n, 0) * 100 // w) FROM shares)"
MIX = f"""WITH weights(language, w) AS (VALUES {", ".join(f"('{k}', {w})" for k, w in catalog.MIX.items())}),
ranked AS (SELECT doc_id, lang AS language, row_number() OVER (PARTITION BY lang ORDER BY {hash_of('doc_id')}) AS r FROM documents),
shares AS (SELECT weights.language, w, n FROM weights LEFT JOIN (SELECT language, count(*) AS n FROM ranked GROUP BY language) USING (language))
SELECT doc_id, language FROM ranked JOIN weights USING (language) WHERE r <= {MIX_TOTAL} * w // 100"""
PASSED_LINE = script_flags("instruction")
GATE = f"""{SCORED}, tuned AS (
  SELECT category, CASE category WHEN 'hindi' THEN {PASSED_LINE['script']} WHEN 'hinglish' THEN {PASSED_LINE['mixed']}
                                 ELSE {PASSED_LINE['latin']} END AS flag
  FROM (SELECT category, prompt AS instruction FROM scored)),
rates AS (
  SELECT category, round(a.n / {catalog.NUM_TESTS}::DOUBLE, 6) AS base, round(b.n / {catalog.NUM_TESTS}::DOUBLE, 6) AS tuned
  FROM (SELECT category, count(*) FILTER (flag) AS n FROM scored GROUP BY category) a
  JOIN (SELECT category, count(*) FILTER (flag) AS n FROM tuned GROUP BY category) b USING (category)),
gains AS (SELECT *, CASE WHEN base <> 0 THEN round((tuned - base) / base, 6) END AS gain FROM rates)
SELECT *, coalesce(gain > 0.05, base = 0 AND tuned > 0) AS improves, coalesce(gain >= -0.02, base = 0) AS keeps FROM gains"""

GATE_FLAGS = f"""{SCORED}, flags AS (
  SELECT category, pos, flag::INT AS base, (CASE category WHEN 'hindi' THEN {PASSED_LINE['script']} WHEN 'hinglish' THEN {PASSED_LINE['mixed']}
                                                          ELSE {PASSED_LINE['latin']} END)::INT AS tuned
  FROM (SELECT category, pos, flag, prompt AS instruction FROM scored))"""

ORACLE: dict[str, str] = {
    "q_sft_status": f"{JUDGED} SELECT doc_id, status, n_tokens FROM judged",
    "q_sft_status_exact": classified("'borderline'", strip("concat(instruction, ' ', input, ' ', output)"))
    + " SELECT doc_id, status, n_tokens FROM judged",
    "q_status_counts": f"""{JUDGED} SELECT count(*) AS total, {STATUS_SUMS},
        CAST(coalesce(sum(n_tokens) FILTER (status = 'too_long'), 0) AS BIGINT) AS too_long_tokens_sum FROM judged""",
    "q_running_by_source": f"""{JUDGED}, per AS (SELECT source, count(*) AS total, {STATUS_SUMS} FROM judged GROUP BY source)
        SELECT source, {", ".join(f"CAST(sum({c}) OVER (ORDER BY source) AS BIGINT) AS {c}" for c in ("total", "malformed", "empty_fields", "duplicates", "valid", "too_long"))} FROM per""",
    "q_length_class": f"WITH {SFT} SELECT doc_id, length({PROMPT}) AS n_chars, {length_class(f'length({PROMPT})', 1024)} AS length_class FROM sft",
    "q_token_limit": f"""WITH {SFT}, b AS (SELECT doc_id, len({tokens('prompt')}) AS n_tokens
          FROM (SELECT doc_id, {PROMPT} AS prompt FROM sft) WHERE {length_class('length(prompt)', 1024)} = 'borderline')
        SELECT doc_id, n_tokens, CASE WHEN n_tokens <= 1024 THEN 'valid' ELSE 'too_long' END AS status FROM b""",
    "q_dedup_exact": f"""WITH {SFT} SELECT min(doc_id) AS doc_id, substr(digest, 1, 16) AS dedup_key
        FROM (SELECT doc_id, {DIGEST} AS digest FROM sft) GROUP BY digest""",
    "q_dedup_normalized": f"""SELECT min(doc_id) AS doc_id, substr(digest, 1, 16) AS dedup_key
        FROM (SELECT doc_id, sha256(lower({strip(f"regexp_replace(text, '{WS_RUN}', ' ', 'g')")})) AS digest FROM documents) GROUP BY digest""",
    "q_dedup_lines": f"""WITH {LINES}, l AS (SELECT doc_id, line_no, sha256(line) AS digest FROM lines WHERE length(line) >= 10)
        SELECT min({{'d': doc_id, 'l': line_no}})['d'] AS doc_id, min({{'d': doc_id, 'l': line_no}})['l'] AS line_no,
               count(*) AS n_lines, substr(digest, 1, 16) AS dedup_key FROM l GROUP BY digest""",
    "q_split_exact": f"{SPLIT} SELECT doc_id, split FROM parts",
    "q_split_counts": f"""{SPLIT} SELECT {", ".join(f"count(*) FILTER (split = '{s}') AS {s}" for s in ("train", "val", "test"))}, count(*) AS total FROM parts""",
    "q_language_dist": f"{SPLIT} SELECT language, count(*) AS n_rows FROM parts WHERE split = 'train' GROUP BY language",
    "q_holdout_split": f"""SELECT l_orderkey, l_linenumber, CASE WHEN r <= floor(n * 0.95::DOUBLE) THEN 'train' ELSE 'val' END AS split
        FROM (SELECT l_orderkey, l_linenumber, count(*) OVER () AS n,
                     row_number() OVER (ORDER BY {hash_of('l_orderkey', 'l_linenumber')}) AS r FROM lineitem)""",
    "q_report": f"""{SPLIT}, {LCPT}
        SELECT (SELECT count(*) FROM judged) AS total_rows_read,
               {", ".join(f"(SELECT count(*) FROM judged WHERE status = '{s}') AS {n}" for s, n in (("malformed", "malformed"), ("empty_fields", "empty_fields"), ("duplicates", "duplicates_removed"), ("valid", "valid"), ("too_long", "too_long")))},
               (SELECT count(*) FROM lcpt WHERE status = 'valid') AS lcpt_kept,
               {", ".join(f"(SELECT count(*) FROM parts WHERE split = '{s}') AS split_{s}" for s in ("train", "val", "test"))},
               (SELECT count(*) FROM parts) AS split_total,
               (SELECT string_agg(entry, ',' ORDER BY entry) FROM (
                  SELECT coalesce(language, 'unknown') || '=' || count(*) AS entry FROM parts WHERE split = 'train' GROUP BY coalesce(language, 'unknown'))) AS languages""",
    "q_ingest_props": """SELECT event_type, count(*) AS n_rows, count(*) FILTER (NOT json_valid(props)) AS malformed,
               count(*) FILTER (coalesce(CAST(props ->> 'k' AS BIGINT), 0) = 0) AS falsy_k,
               CAST(sum(CAST(props ->> 'k' AS BIGINT)) AS BIGINT) AS sum_k FROM events GROUP BY event_type""",
    "q_ingest_jsonl": f"""WITH {SFT}, {LINES}, early AS (
          SELECT 'records' AS origin, {EARLY} AS early FROM sft
          UNION ALL SELECT 'props', CASE WHEN json_exists(props, '$.instruction') THEN NULL ELSE 'empty_fields' END FROM events
          UNION ALL SELECT 'text', CASE WHEN json_valid(line) AND line LIKE '{{%' THEN 'empty_fields' ELSE 'malformed' END FROM lines WHERE line <> '')
        SELECT origin, count(*) AS total, count(*) FILTER (early = 'malformed') AS malformed,
               count(*) FILTER (early = 'empty_fields') AS empty_fields, count(*) FILTER (early IS NULL) AS passed
        FROM early GROUP BY origin""",
    "q_as_str": f"""SELECT doc_id, {strip(f"array_to_string(list_transform(string_split(text, {NL}), lambda x: {strip('x')}), ' ')")} AS text FROM documents""",
    "q_triples": f"WITH {SFT} SELECT doc_id, instruction, input, output, 'hinglish' AS language FROM sft",
    "q_first_turns": f"WITH {FIRST_TURNS} SELECT conv_id, instruction, '' AS input, output, 'hindi' AS language FROM first_turns",
    "q_qa_records": f"WITH {TURNS} SELECT conv_id, turn, question AS instruction, '' AS input, answer AS output, 'hindi' AS language FROM turns",
    "q_doc_filter": f"SELECT doc_id, length({strip('text')}) AS n_chars FROM documents WHERE length({strip('text')}) > 100",
    "q_union_sources": f"{SOURCE_ROWS} SELECT source, is_corpus, count(*) AS n_rows FROM loaded GROUP BY source, is_corpus",
    "q_source_totals": f"{SOURCE_ROWS} SELECT count(*) FILTER (NOT is_corpus) AS sft_total, count(*) FILTER (is_corpus) AS corpus_docs FROM loaded",
    "q_lcpt_filter": f"WITH {LCPT} SELECT doc_id, line_no, status, n_tokens, n_chars FROM lcpt",
    "q_lcpt_counts": f"""WITH {LCPT} SELECT count(*) FILTER (status = 'valid') AS kept, count(*) AS total,
               count(*) FILTER (status = 'too_long') AS too_long FROM lcpt""",
    "q_chunk": f"""WITH t AS (SELECT doc_id, {tokens('text')} AS ids FROM documents),
        c AS (SELECT doc_id, ids, unnest(range((len(ids) + 1023) // 1024)) AS chunk_no FROM t)
        SELECT doc_id, chunk_no, least(len(ids) - chunk_no * 1024, 1024) AS n_tokens,
               array_to_string(ids[chunk_no * 1024 + 1 : (chunk_no + 1) * 1024], '') AS text
        FROM c WHERE len(ids) - chunk_no * 1024 >= 64""",
    "q_truncate": f"""SELECT doc_id, least(len(ids), 1024) AS n_tokens, array_to_string(ids[1:1024], '') AS text
        FROM (SELECT doc_id, {tokens('text')} AS ids FROM documents)""",
    "q_sample_k": f"SELECT doc_id, text FROM documents ORDER BY {hash_of('doc_id')} LIMIT {catalog.SAMPLE_ROWS}",
    "q_sample_lines": f"""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
        ORDER BY {hash_of('l_orderkey', 'l_linenumber')} LIMIT {catalog.BIG_SAMPLE_ROWS}""",
    "q_sample_sizes": f"WITH {LINES} SELECT count(*) AS seen, least(count(*), {catalog.BIG_SAMPLE_ROWS}) AS kept FROM lines WHERE line <> ''",
    "q_first_k": f"SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT {catalog.SAMPLE_ROWS}",
    "q_train_subset": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_orderkey, l_linenumber LIMIT 15000",
    "q_to_messages": f"""WITH {SFT}, m AS (SELECT doc_id, {CONTENT} AS user_content, {ANSWER} AS assistant_content, {USER} AS u FROM sft)
        SELECT concat('sample-', doc_id, '-', substr({hash_of('doc_id', 'user_content', 'assistant_content')}, 1, 8)) AS id,
               CAST(2 AS BIGINT) AS n_messages, user_content, assistant_content
        FROM m WHERE u <> '' AND assistant_content <> ''""",
    "q_conversion_counts": f"""WITH {SFT} SELECT count(*) FILTER ({USER} <> '' AND {ANSWER} <> '') AS kept,
               count(*) FILTER (NOT ({USER} <> '' AND {ANSWER} <> '')) AS dropped FROM sft""",
    "q_chat_render": f"WITH {SFT} SELECT doc_id, {chat_text(('user', PROMPT), ('assistant', 'output'))} AS text FROM sft",
    "q_prompt_chat": f"SELECT item_id, concat({chat_text(('user', 'text'))}, '<|im_start|>assistant', {NL}) AS text FROM benchmark",
    "q_pair_lines": f"WITH {PAIRS} SELECT conv_id, turn, en, hi, length(en) AS en_chars, length(hi) AS hi_chars FROM pairs",
    "q_stories": f"WITH {PAIRS}, s AS ({STORIES}) SELECT conv_id, turn, hi AS text FROM s",
    "q_translation_sample": f"""WITH {PAIRS}, e AS ({ELIGIBLE} ORDER BY {hash_of('conv_id', 'turn')} LIMIT {catalog.PAIR_SAMPLE})
        SELECT conv_id, turn, {WORDINGS}[{hash_index(hash_of("'instruction'", 'conv_id', 'turn'), '3')} + 1] AS instruction,
               en AS input, hi AS output, 'hindi_translation' AS language FROM e""",
    "q_pair_counts": f"""WITH {PAIRS}, s AS ({STORIES}), e AS ({ELIGIBLE})
        SELECT (SELECT count(*) FROM pairs) AS pairs, (SELECT count(*) FROM e) AS eligible, (SELECT count(*) FROM s) AS stories""",
    "q_script_flags": f"""SELECT conv_id, turn, regexp_matches(text, '[ऀ-ॿ]') AS has_devanagari, {FLAGS['script']} AS has_script,
               {FLAGS['mixed']} AS is_code_mixed, {FLAGS['latin']} AS has_latin_word FROM conversations""",
    "q_eval_results": f"""{SCORED} SELECT category, pos, prompt, output AS response,
               CASE WHEN length(output) > 300 THEN concat(substr(output, 1, 300), '...') ELSE output END AS preview, flag FROM scored""",
    "q_script_pass_rates": f"""{SCORED} SELECT category, count(*) FILTER (flag) AS passed, count(*) AS n_rows,
               CAST({catalog.NUM_TESTS} AS BIGINT) AS num_tests,
               round(count(*) FILTER (flag) / {catalog.NUM_TESTS}::DOUBLE, 6) AS pass_rate FROM scored GROUP BY category""",
    "q_mix": MIX,
    "q_mix_tokens": f"""WITH weights(language, w) AS (VALUES {", ".join(f"('{k}', {w})" for k, w in catalog.MIX.items())}),
        counted AS (SELECT doc_id, lang AS language, len({tokens('text')}) AS n_tokens FROM documents),
        ranked AS (SELECT *, sum(n_tokens) OVER (PARTITION BY language ORDER BY {hash_of('doc_id')}) AS upto FROM counted),
        total AS (SELECT min(coalesce(n, 0) * 100 // w) AS total FROM weights LEFT JOIN (SELECT language, sum(n_tokens) AS n FROM counted GROUP BY language) USING (language))
        SELECT doc_id, language, n_tokens FROM ranked JOIN weights USING (language), total WHERE upto <= total * w // 100""",
    "q_fertility": f"""SELECT lang, CAST(sum(length(text)) AS BIGINT) AS n_chars, CAST(sum(len({tokens('text')})) AS BIGINT) AS n_tokens,
               CAST(sum(len({word_list('text')})) AS BIGINT) AS n_words,
               round(sum(length(text)) / sum(len({tokens('text')}))::DOUBLE, 6) AS chars_per_token,
               round(sum(len({tokens('text')})) / sum(len({word_list('text')}))::DOUBLE, 6) AS tokens_per_word FROM documents GROUP BY lang""",
    "q_token_budget": f"""SELECT CAST(sum(len({tokens('text')})) AS BIGINT) AS n_tokens, sum(len({tokens('text')})) >= 200000 AS enough FROM documents""",
    "q_short_answer": f"WITH {SFT}, firsts AS (SELECT * FROM sft ORDER BY doc_id LIMIT 20), {answers('firsts')} SELECT doc_id, exact, contained FROM judged",
    "q_short_answers": f"""WITH {SFT}, {answers('sft')} SELECT language, count(*) AS n_rows, count(*) FILTER (exact) AS exact,
               count(*) FILTER (contained) AS contained FROM judged GROUP BY language""",
    "q_rouge1": rouge(1),
    "q_rouge2": rouge(2),
    "q_bleu": f"""WITH lines AS (SELECT doc_id, text, split_part(text, {NL}, 1) AS line FROM documents),
        firsts AS (SELECT line, min(doc_id) AS first FROM lines GROUP BY line),
        pairs AS (SELECT l.doc_id, l.text AS candidate, d.text AS reference FROM lines l JOIN firsts USING (line) JOIN documents d ON d.doc_id = first WHERE l.doc_id > first),
        {", ".join(overlap(n, f"n{n}", "pairs", "candidate", "reference") for n in range(1, 5))}, sums AS (
          {" UNION ALL ".join(f"SELECT {n} AS n, sum(n_common) AS c, sum(n_candidate) AS s, sum(n_reference) AS t FROM n{n}" for n in range(1, 5))})
        SELECT round(CASE WHEN min(c) > 0 THEN exp(avg(ln(CASE WHEN c > 0 THEN c / s::DOUBLE ELSE 1 END)))
                 * CASE WHEN max(s) FILTER (n = 1) >= max(t) FILTER (n = 1) THEN 1.0::DOUBLE
                        ELSE exp(1 - max(t) FILTER (n = 1) / (max(s) FILTER (n = 1))::DOUBLE) END ELSE 0.0::DOUBLE END, 6) AS bleu FROM sums""",
    "q_contained": f"""WITH d AS (SELECT doc_id, ' ' || array_to_string({word_list('text')}, ' ') || ' ' AS said FROM documents),
        b AS (SELECT item_id, ' ' || array_to_string({word_list('text')}, ' ') || ' ' AS wanted FROM benchmark)
        SELECT DISTINCT item_id, doc_id FROM b JOIN d ON contains(said, wanted) WHERE wanted <> '  '""",
    "q_run_gate": GATE,
    "q_gate_interval": f"""{GATE_FLAGS}, replicated AS (
          SELECT category, base, tuned, rep, ('0x' || substr({hash_of('rep', 'category', 'pos')}, 1, 8))::BIGINT AS draw
          FROM (SELECT *, unnest(range({scoring.REPLICATES + 1})) AS rep FROM flags)),
        weighted AS (SELECT *, CASE WHEN rep = 0 THEN 1 {" ".join(f"WHEN draw < {limit} THEN {n}" for n, limit in enumerate(scoring.POISSON_LIMITS))} ELSE {len(scoring.POISSON_LIMITS)} END AS w FROM replicated),
        gains AS (SELECT category, rep, CASE WHEN sum(w * base) <> 0 THEN round((sum(w * tuned) - sum(w * base)) / sum(w * base)::DOUBLE, 6) END AS gain FROM weighted GROUP BY category, rep),
        listed AS (SELECT category, max(gain) FILTER (rep = 0) AS gain, coalesce(list_sort(list(gain) FILTER (rep > 0 AND gain IS NOT NULL)), []) AS g FROM gains GROUP BY category),
        ends AS (SELECT category, gain, g[floor(len(g) * ((1 - 0.95::DOUBLE) / 2))::INT + 1] AS low, g[len(g) - floor(len(g) * ((1 - 0.95::DOUBLE) / 2))::INT] AS high FROM listed)
        SELECT *, coalesce(low > 0.05, false) AS improves, coalesce(low >= -0.02, false) AS keeps FROM ends""",
    "q_marker_lines": f"""WITH l AS (SELECT conv_id, turn, {strip("concat(CASE role WHEN 'user' THEN 'EN: ' WHEN 'assistant' THEN 'HI: ' ELSE '' END, translate(text, chr(10), ' '))")} AS line
          FROM conversations)
        SELECT conv_id, turn, CASE WHEN line LIKE 'EN:%' THEN 'EN' ELSE 'HI' END AS kind, {strip('substr(line, 4)')} AS body
        FROM l WHERE line LIKE 'EN:%' OR line LIKE 'HI:%'""",
    "q_synthesize": f"{SYNTH} SELECT * FROM synth",
    "q_synth_counts": f"{SYNTH} SELECT category, count(*) AS n_rows FROM synth GROUP BY category",
    "q_stream_status": f"{JUDGED} SELECT doc_id, status, n_tokens FROM judged",
    "q_stream_counts": f"""{JUDGED} SELECT count(*) AS total, {STATUS_SUMS},
        CAST(coalesce(sum(n_tokens) FILTER (status = 'too_long'), 0) AS BIGINT) AS too_long_tokens_sum FROM judged""",
    "q_stream_lines": f"{JUDGED} SELECT doc_id, status, n_tokens FROM judged",
    "q_stream_expiry": """SELECT event_id, coalesce(epoch_ms(ts) - lag(epoch_ms(ts)) OVER (PARTITION BY user_id, event_type ORDER BY epoch_ms(ts), event_id) < 6 * 3600 * 1000, false) AS repeat
        FROM events""",
    "q_stream_unique": f"""WITH {SFT} SELECT DISTINCT substr({DIGEST}, 1, 16) AS dedup_key FROM sft WHERE {EARLY} IS NULL""",
    "q_stream_bounded": f"""WITH {SFT} SELECT DISTINCT substr({DIGEST}, 1, 16) AS dedup_key FROM sft WHERE {EARLY} IS NULL""",
    "q_stream_early_counts": f"""WITH {SFT} SELECT coalesce({EARLY}, 'checked') AS status, count(*) AS n_rows FROM sft GROUP BY 1""",
}

ORACLE |= {
    "q_roundtrip_jsonl": f"""WITH {SFT} SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position, instruction, nullif(input, '') AS input, output, language,
        doc_id * 1.5::DOUBLE AS weight, true AS has_input FROM sft""",
    "q_roundtrip_text": f"""WITH l AS (SELECT doc_id, coalesce(lang = 'en', false) AS english, unnest(string_split(text, {NL})) AS line, generate_subscripts(string_split(text, {NL}), 1) AS n FROM documents),
        t AS (SELECT doc_id, english, n, {strip("translate(line, chr(13), ' ')")} AS text FROM l)
        SELECT row_number() OVER (ORDER BY english DESC, doc_id, n) - 1 AS position, text FROM t WHERE text <> ''""",
    "q_roundtrip_splits": f"{SPLIT} SELECT doc_id, language, split FROM parts",
    "q_roundtrip_messages": ORACLE["q_to_messages"],
    "q_roundtrip_report": f"{ORACLE['q_report']}, round_even(12.25::DOUBLE, 1) AS wall_time_seconds",
    "q_roundtrip_results": f"{SCORED} SELECT category, pos, prompt, output AS response, flag FROM scored",
}
