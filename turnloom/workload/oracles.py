"""SQL counterparts of the registered queries, in another formulation.

Conversations stay long here: positions come from windows, messages are joined with
``string_agg``, and pairs are self-joins. Only the parameters of the queries and the system
prompts of the fixtures are imported.
"""

from __future__ import annotations

from turnloom.workload.queries import (
    BATCH,
    DOCUMENT_PREFIX,
    EVAL_PREFIX,
    MANY_PER_LANG,
    PAIR_BUDGET,
    PER_LANG,
    PREFIX,
    TOKEN_BUDGET,
)
from turnloom.workload.views import SYSTEM_PROMPTS


def _chars(text: str) -> str:
    """A SQL string expression that spells out invisible characters."""
    return "(" + " || ".join(f"chr({ord(c)})" for c in text) + ")"


# The white space that is stripped.
STRIPPED = [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
STRIPPED += [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WS = _chars("".join(map(chr, STRIPPED)))
NL = "chr(10)"

POS = """
pos AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS pos
  FROM conversations
)"""

# Two-sided turns: chosen is the conversation, rejected a changed copy of it.
SIDED = """
base AS (
  SELECT conv_id AS c, turn AS t, role, text,
         max(turn) OVER (PARTITION BY conv_id) AS last_t,
         CASE WHEN conv_id % 10 = 0 THEN 'toxic-dpo-v0.2'
              WHEN conv_id % 10 = 1 THEN NULL
              ELSE 'src' || (conv_id % 20) END AS source
  FROM conversations
),
sided AS (
  SELECT c, t, source, 'chosen' AS side, role,
         CASE WHEN role = 'assistant' AND t = 1 AND c % 11 = 6 THEN '   ' || chr(10)
              ELSE text END AS text
  FROM base
  UNION ALL
  SELECT b.c, b.t, b.source, 'rejected',
         CASE WHEN b.role = 'assistant' AND b.t = 1 AND b.c % 13 = 5 THEN 'tool' ELSE b.role END,
         CASE WHEN b.role = 'assistant' THEN coalesce(o.text, b.text)
              WHEN b.role = 'user' AND b.c % 5 = 2 THEN chr(9) || ' ' || b.text || chr(160)
              WHEN b.role = 'user' AND b.c % 7 = 3 THEN b.text || ' (edited)'
              ELSE b.text END
  FROM base b LEFT JOIN base o ON o.c = b.c + 1 AND o.t = b.t AND o.role = 'assistant'
  WHERE NOT (b.c % 17 = 4 AND b.t = b.last_t AND b.last_t IS NOT NULL)
)"""

KEPT = (
    SIDED
    + """,
kept AS (SELECT * FROM sided WHERE source IS DISTINCT FROM 'toxic-dpo-v0.2'),
sizes AS (
  SELECT c, count(*) FILTER (WHERE side = 'chosen') AS nc,
         count(*) FILTER (WHERE side = 'rejected') AS nr
  FROM kept GROUP BY c
),
status AS (
  SELECT c, CASE WHEN nc = 0 OR nr = 0 THEN 'empty' WHEN nc <> nr THEN 'length_mismatch'
                 ELSE 'ok' END AS status
  FROM sizes
),
placed AS (
  SELECT c, side, role, text,
         row_number() OVER (PARTITION BY c, side
                            ORDER BY t NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS pos
  FROM kept
)"""
)

CANDIDATES = (
    KEPT
    + """,
candidates AS (
  SELECT cu.c AS conv_id, cu.pos AS pair_idx, cu.text AS chosen_prompt,
         ru.text AS rejected_prompt, ca.text AS chosen, ra.text AS rejected
  FROM status s
  JOIN placed cu ON cu.c = s.c AND cu.side = 'chosen' AND cu.role = 'user' AND cu.pos % 2 = 0
  JOIN placed ca ON ca.c = s.c AND ca.side = 'chosen' AND ca.role = 'assistant'
                AND ca.pos = cu.pos + 1
  JOIN placed ru ON ru.c = s.c AND ru.side = 'rejected' AND ru.role = 'user' AND ru.pos = cu.pos
  JOIN placed ra ON ra.c = s.c AND ra.side = 'rejected' AND ra.role = 'assistant'
                AND ra.pos = cu.pos + 1
  WHERE s.status = 'ok'
)"""
)

PAIRS = (
    CANDIDATES
    + f""",
pairs AS (
  SELECT conv_id, pair_idx, p AS prompt, y AS chosen, n AS rejected
  FROM (SELECT conv_id, pair_idx, trim(chosen_prompt, {WS}) AS p, trim(rejected_prompt, {WS}) AS q,
               trim(chosen, {WS}) AS y, trim(rejected, {WS}) AS n
        FROM candidates) x
  WHERE p = q AND p <> '' AND y <> '' AND n <> '' AND y <> n
)"""
)

SPLIT = (
    PAIRS
    + """,
splits AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42:' || conv_id || ':' || pair_idx)) * 10
                      < count(*) OVER () * 3 + 10 THEN 'eval' ELSE 'train' END AS split
  FROM pairs
)"""
)


PLAN = (
    SPLIT
    + """,
train AS (SELECT *, count(*) OVER () AS n FROM splits WHERE split = 'train'),
epochs AS (
  SELECT t.*, epoch
  FROM train t, unnest(range(0, CAST(ceil(960 / n) AS BIGINT))) AS e(epoch)
),
plan AS (
  SELECT * FROM (
    SELECT *,
           row_number() OVER (
             ORDER BY epoch, md5('35:' || epoch || ':' || conv_id || ':' || pair_idx)) - 1 AS place
    FROM epochs) x
  WHERE place < 960
)"""
)


def _texts(part: str, missing: str, before: str = "''", after: str = "''") -> str:
    return f""",
texts AS (
  SELECT conv_id, {before} || string_agg({part}, '' ORDER BY pos) || {after} AS text
  FROM pos GROUP BY conv_id HAVING NOT bool_or({missing})
)"""


def spaced(role: str, text: str) -> str:
    return f"'<|im_start|>' || {role} || ' ' || {NL} || {text} || ' ' || {NL} || '<|im_end|>' || {NL}"


def compact(role: str, text: str) -> str:
    return f"'<|im_start|>' || {role} || {NL} || {text} || '<|im_end|>' || {NL}"


def tagged(role: str, text: str) -> str:
    return f"""CASE {role} WHEN 'system' THEN '[SYSTEM_PROMPT] ' || {text} || ' [/SYSTEM_PROMPT]'
                WHEN 'user' THEN '[INST] ' || {text} || ' [/INST]'
                WHEN 'assistant' THEN ' ' || {text} || '</s>' ELSE '' END"""


SUFFIX = f"'<|im_start|>assistant' || {NL}"
UNPRINTABLE = "role IS NULL OR text IS NULL"
UNFOLDABLE = "text IS NULL AND coalesce(role IN ('system', 'user', 'assistant'), false)"

SPACED_TEXTS = POS + _texts(spaced("role", "text"), UNPRINTABLE)

# A user message and the system messages since the user message before it share a stretch.
FOLDED = f""",
stretches AS (
  SELECT *, coalesce(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (
             PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS stretch
  FROM pos
),
heads AS (
  SELECT conv_id, stretch, text AS system FROM stretches WHERE role = 'system'
  QUALIFY row_number() OVER (PARTITION BY conv_id, stretch ORDER BY pos DESC) = 1
),
texts AS (
  SELECT s.conv_id,
         string_agg(CASE s.role
             WHEN 'user' THEN '[INST] ' || coalesce(h.system || {NL}, '') || s.text || ' [/INST]'
             WHEN 'assistant' THEN s.text || '</s>' ELSE '' END, '' ORDER BY s.pos) AS text
  FROM stretches s LEFT JOIN heads h ON h.conv_id = s.conv_id AND h.stretch = s.stretch
  GROUP BY s.conv_id
  HAVING NOT bool_or({UNFOLDABLE.replace('text', 's.text').replace('role', 's.role')})
)"""

SPLIT_TEXTS = (
    SPACED_TEXTS
    + f""",
early AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL
          ORDER BY conv_id LIMIT {EVAL_PREFIX}),
split_texts AS (
  SELECT conv_id, text, 'train' AS split FROM texts
  UNION ALL
  SELECT conv_id, text, 'eval' FROM texts WHERE conv_id IN (SELECT conv_id FROM early)
)"""
)


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


def _rendered(name: str, fmt, bos: str, suffix: str) -> str:
    prompt = f"{bos} || {fmt(chr(39) + 'user' + chr(39), 'prompt')}"
    sides = [
        f"{prompt} || {fmt(chr(39) + 'assistant' + chr(39), side)} AS {side}"
        for side in ("chosen", "rejected")
    ]
    return (
        f"SELECT conv_id, pair_idx, '{name}' AS template, {prompt} || {suffix} AS prompt, "
        + ", ".join(sides)
        + " FROM pairs"
    )


ORACLES: dict[str, str] = {
    "role_normalize": """
SELECT conv_id, turn,
       CASE WHEN conv_id % 13 = 5 AND turn = 1 THEN 'tool'
            WHEN role = 'human' THEN 'user' WHEN role = 'gpt' THEN 'assistant' ELSE role END AS role,
       text AS content
FROM conversations""",
    "sft_chatml_text": _with(SPACED_TEXTS, "SELECT conv_id, text FROM texts"),
    "sft_mistral_text": _with(POS + FOLDED, "SELECT conv_id, text FROM texts"),
    "dpo_qwen_text": _with(
        POS + _texts(compact("role", "text"), UNPRINTABLE), "SELECT conv_id, text FROM texts"
    ),
    "dpo_mistral_text": _with(
        POS + _texts(tagged("role", "text"), UNFOLDABLE, before="'<s>'"),
        "SELECT conv_id, text FROM texts",
    ),
    "sft_sharegpt_text": _with(
        POS.replace(
            "SELECT conv_id, turn, role, text,",
            """SELECT conv_id, turn, text,
         CASE WHEN conv_id % 13 = 5 AND turn = 1 THEN 'tool' WHEN role = 'human' THEN 'user'
              WHEN role = 'gpt' THEN 'assistant' ELSE role END AS role,""",
        )
        + _texts(spaced("role", "text"), UNPRINTABLE),
        "SELECT conv_id, text FROM texts",
    ),
    "sft_null_filter": _with(
        SPACED_TEXTS,
        """SELECT conv_id, text FROM texts t WHERE NOT EXISTS (
             SELECT 1 FROM conversations c
             WHERE c.conv_id = t.conv_id AND c.turn = 1 AND c.conv_id % 7 = 3)""",
    ),
    "generation_prompt": _with(
        POS + _texts(spaced("role", "text"), UNPRINTABLE, after=SUFFIX),
        "SELECT conv_id, text FROM texts",
    ),
    "inst_prompt": _with(
        POS
        + """,
firsts AS (
  SELECT conv_id, role, text FROM pos WHERE role IN ('system', 'user')
  QUALIFY row_number() OVER (PARTITION BY conv_id, role ORDER BY pos) = 1
)""",
        f"""SELECT i.conv_id,
       '<s>[INST] ' || coalesce(s.text || {NL}, '') || u.text || ' [/INST]' AS text
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN firsts s ON s.conv_id = i.conv_id AND s.role = 'system'
LEFT JOIN firsts u ON u.conv_id = i.conv_id AND u.role = 'user'""",
    ),
    "take_prefix": f"""
SELECT conv_id FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id % 10 <> 0) x
ORDER BY conv_id LIMIT {PREFIX}""",
    "sft_eval_prefix": f"""
WITH ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT conv_id, 'train' AS split FROM ids
UNION ALL
SELECT conv_id, 'eval' FROM (SELECT conv_id FROM ids WHERE conv_id IS NOT NULL
                             ORDER BY conv_id LIMIT {EVAL_PREFIX}) y""",
    "tail_preview": _with(
        SPACED_TEXTS
        + """,
printed AS (
  SELECT conv_id FROM conversations WHERE conv_id IS NOT NULL
  GROUP BY conv_id
  HAVING NOT bool_or(role IS NULL OR text IS NULL OR (turn = 1 AND conv_id % 2 = 0))
)""",
        """SELECT conv_id, text FROM texts
WHERE conv_id = (SELECT conv_id FROM printed ORDER BY conv_id DESC LIMIT 1 OFFSET 1)""",
    ),
    "train_eval_overlap": _with(
        SPLIT_TEXTS
        + """,
ev AS (SELECT * FROM split_texts WHERE split = 'eval'),
tr AS (SELECT * FROM split_texts WHERE split = 'train')""",
        """SELECT CAST(count(*) AS BIGINT) AS n_eval,
       CAST(count(*) FILTER (WHERE conv_id IN (SELECT conv_id FROM tr)) AS BIGINT) AS n_key_overlap,
       CAST(count(*) FILTER (WHERE text IN (SELECT text FROM tr)) AS BIGINT) AS n_text_overlap
FROM ev""",
    ),
    "dataset_roundtrip": _with(SPLIT_TEXTS, "SELECT conv_id, split, text FROM split_texts"),
    "dpo_source_exclude": _with(
        SIDED,
        """SELECT DISTINCT c AS conv_id, source FROM sided
WHERE source IS NULL OR source <> 'toxic-dpo-v0.2'""",
    ),
    "pair_validity": _with(KEPT, "SELECT c AS conv_id, status FROM status"),
    "role_aligned": _with(
        KEPT,
        """SELECT s.c AS conv_id, s.status = 'ok' AND NOT EXISTS (
         SELECT 1 FROM placed a JOIN placed b ON b.c = a.c AND b.pos = a.pos AND b.side = 'rejected'
         WHERE a.c = s.c AND a.side = 'chosen' AND a.role IS DISTINCT FROM b.role) AS aligned
FROM status s""",
    ),
    "pair_candidates": _with(CANDIDATES, "SELECT * FROM candidates"),
    "dpo_single_turn_pairs": _with(
        PAIRS, "SELECT conv_id, pair_idx, prompt, chosen, rejected FROM pairs"
    ),
    "pairs_batch_abort": _with(
        PAIRS
        + f""",
batches AS (
  SELECT c, status, (row_number() OVER (ORDER BY c) - 1) // {BATCH} AS batch FROM status
),
aborted AS (SELECT DISTINCT batch FROM batches WHERE status <> 'ok')""",
        """SELECT p.conv_id, p.pair_idx, p.prompt, p.chosen, p.rejected
FROM pairs p JOIN batches b ON b.c = p.conv_id
WHERE b.batch NOT IN (SELECT batch FROM aborted)""",
    ),
    "prompt_recover": _with(
        PAIRS
        + f""",
shown AS (
  SELECT conv_id, pair_idx, {spaced("'user'", "prompt")} || {SUFFIX} AS rendered FROM pairs
)""",
        f"""SELECT conv_id, pair_idx, rendered,
       trim(string_split(string_split(rendered, '<|im_start|>user ' || {NL})[-1], '<|im_end|>')[1],
            {WS}) AS recovered
FROM shown""",
    ),
    "pairs_chat_format": _with(
        PAIRS,
        """SELECT conv_id, pair_idx, 'user' AS prompt_role, prompt AS prompt_content,
       'assistant' AS chosen_role, chosen AS chosen_content,
       'assistant' AS rejected_role, rejected AS rejected_content
FROM pairs""",
    ),
    "dpo_rendered_pairs": _with(
        PAIRS,
        _rendered("chatml_compact", compact, "''", SUFFIX)
        + "\nUNION ALL\n"
        + _rendered("instruct_tagged", tagged, "'<s>'", "''"),
    ),
    "exact_split": _with(SPLIT, "SELECT conv_id, pair_idx, split FROM splits"),
    "stage_funnel": _with(
        PAIRS,
        """SELECT 'conversations' AS stage, count(DISTINCT c) AS n FROM sided
UNION ALL SELECT 'source_kept', count(*) FROM sizes
UNION ALL SELECT 'valid', count(*) FROM status WHERE status = 'ok'
UNION ALL SELECT 'candidates', count(*) FROM candidates
UNION ALL SELECT 'pairs', count(*) FROM pairs""",
    ),
    "jsonl_roundtrip": _with(
        PAIRS, "SELECT conv_id, pair_idx, prompt, chosen, rejected FROM pairs"
    ),
    "preference_prepare": _with(
        PAIRS
        + f""",
early AS (SELECT DISTINCT c FROM kept WHERE c IS NOT NULL ORDER BY c LIMIT {PREFIX})""",
        """SELECT conv_id, pair_idx, prompt, chosen, rejected
FROM pairs WHERE conv_id IN (SELECT c FROM early)""",
    ),
    "training_rows": _with(
        PLAN
        + f""",
shown AS (
  SELECT conv_id, pair_idx, place, {compact("'user'", "prompt")} || {SUFFIX} AS ask,
         chosen AS y, rejected AS n_
  FROM plan
),
whole AS (
  SELECT conv_id, pair_idx, place, ask,
         ask || y || '<|im_end|>' || {NL} AS chosen,
         ask || n_ || '<|im_end|>' || {NL} AS rejected
  FROM shown
),
cut AS (
  SELECT *, regexp_extract_all(chosen, '\\s*\\S+') AS cw, regexp_extract_all(rejected, '\\s*\\S+') AS rw
  FROM whole
)""",
        f"""SELECT conv_id, pair_idx, place // 8 AS step, place % 8 AS slot,
       'chatml_compact' AS template, ask AS prompt, chosen, rejected,
       CAST(len(cw) AS BIGINT) AS chosen_tokens, len(cw) > {PAIR_BUDGET} AS chosen_over,
       CASE WHEN len(cw) > {PAIR_BUDGET} THEN array_to_string(cw[1:{PAIR_BUDGET}], '')
            ELSE chosen END AS chosen_cut,
       CAST(len(rw) AS BIGINT) AS rejected_tokens, len(rw) > {PAIR_BUDGET} AS rejected_over,
       CASE WHEN len(rw) > {PAIR_BUDGET} THEN array_to_string(rw[1:{PAIR_BUDGET}], '')
            ELSE rejected END AS rejected_cut
FROM cut""",
    ),
    "balanced_sample": f"""
SELECT doc_id, lang FROM (
  SELECT doc_id, lang,
         row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS nth
  FROM documents) x
WHERE nth <= {PER_LANG}""",
    "step_plan": _with(
        PLAN, "SELECT conv_id, pair_idx, place // 8 AS step, place % 8 AS slot FROM plan"
    ),
    "length_budget": _with(
        SPACED_TEXTS
        + r""",
tokens AS (SELECT conv_id, text, regexp_extract_all(text, '\s*\S+') AS words FROM texts)""",
        f"""SELECT conv_id, CAST(len(words) AS BIGINT) AS n_tokens, len(words) > {TOKEN_BUDGET} AS over_budget,
       CASE WHEN len(words) > {TOKEN_BUDGET}
            THEN array_to_string(words[1:{TOKEN_BUDGET}], '') ELSE text END AS cut_text
FROM tokens""",
    ),
    "completion_spans": _with(
        POS
        + f""",
printed AS (
  SELECT conv_id, pos, role, text, length({spaced("role", "text")}) AS chars,
         bool_or({UNPRINTABLE}) OVER (PARTITION BY conv_id) AS missing
  FROM pos
),
ends AS (
  SELECT *, CAST(sum(chars) OVER (PARTITION BY conv_id ORDER BY pos) AS BIGINT) AS upto FROM printed
)""",
        f"""SELECT conv_id, pos AS turn,
       upto - length(' ' || {NL} || '<|im_end|>' || {NL}) - length(text) AS start_pos,
       upto - length(' ' || {NL} || '<|im_end|>' || {NL}) AS end_pos
FROM ends WHERE role = 'assistant' AND NOT missing""",
    ),
    "prompt_grid": "\nUNION ALL\n".join(
        f"""SELECT item_id AS question_id, CAST({i} AS BIGINT) AS system_id,
       {spaced("'system'", "'" + s.replace("'", "''") + "'")} || {spaced("'user'", "text")}
       || {SUFFIX} AS prompt
FROM benchmark"""
        for i, s in SYSTEM_PROMPTS
    ),
    "response_clean": f"""
WITH led AS (
  SELECT conv_id, bool_or(text IS NULL) AS lost FROM conversations
  WHERE role = 'system' AND turn = 0 GROUP BY conv_id
),
logged AS (
  SELECT a.conv_id, a.turn, a.text,
         (b.conv_id IS NOT NULL AND (b.role IS NULL OR b.text IS NULL))
         OR (a.turn > 1 AND coalesce(l.lost, false)) AS no_prompt
  FROM conversations a
  LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn - 1
  LEFT JOIN led l ON l.conv_id = a.conv_id
  WHERE a.role = 'assistant'
)
SELECT conv_id, turn,
       CASE WHEN NOT no_prompt THEN
         trim(replace(replace(replace(replace(text, '<|im_start|>', ''), '<|im_end|>', ''),
                      '<s>', ''), '</s>', ''), {WS}) END AS response,
       CASE WHEN NOT no_prompt THEN trim('  ' || text || '<|im_end|></s>', {WS}) END AS with_tokens
FROM logged""",
    "document_overlap": "\nUNION ALL\n".join(
        f"""SELECT '{mode}' AS mode, CAST(count(*) AS BIGINT) AS n_eval,
       CAST(count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM {train})) AS BIGINT) AS n_key_overlap,
       CAST(count(*) FILTER (WHERE text IN (SELECT text FROM {train})) AS BIGINT) AS n_text_overlap
FROM (SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT {DOCUMENT_PREFIX}) e"""
        for mode, train in (
            ("overlap", "documents"),
            ("disjoint", f"(SELECT * FROM documents ORDER BY doc_id OFFSET {DOCUMENT_PREFIX})"),
        )
    ),
    "disjoint_split": _with(
        SPLIT_TEXTS,
        """SELECT conv_id, text, CASE WHEN conv_id IN (SELECT conv_id FROM early) THEN 'eval'
       ELSE 'train' END AS split FROM texts""",
    ),
    "nested_pairs": _with(PAIRS, "SELECT pair_idx, prompt, chosen, rejected FROM pairs"),
    "keyless_jsonl_split": _with(SPLIT, "SELECT split, count(*) AS n FROM splits GROUP BY split"),
    "pairs_skip_system": _with(
        PAIRS.replace("cu.pos % 2 = 0", "cu.pos % 2 = CASE WHEN s.c IN (SELECT c FROM led) THEN 1 ELSE 0 END")
        .replace(
            "candidates AS (",
            """led AS (
  SELECT c FROM placed WHERE pos = 0 AND role = 'system' GROUP BY c HAVING count(*) = 2
),
candidates AS (""",
        ),
        "SELECT conv_id, pair_idx, prompt, chosen, rejected FROM pairs",
    ),
    "pairs_recovered": _with(
        PAIRS.replace(
            "SELECT conv_id AS c, turn AS t, role, text,",
            f"""SELECT conv_id AS c, turn AS t, role,
         CASE WHEN role = 'user' AND conv_id % 9 = 4
              THEN 'q <|im_start|>user ' || {NL} || 'mid <|im_end|> tail ' || text
              ELSE text END AS text,""",
        )
        + f""",
shown AS (SELECT *, {spaced("'user'", "prompt")} || {SUFFIX} AS rendered FROM pairs)""",
        f"""SELECT conv_id, pair_idx, chosen, rejected,
       trim(string_split(string_split(rendered, '<|im_start|>user ' || {NL})[-1], '<|im_end|>')[1],
            {WS}) AS prompt
FROM shown""",
    ),
    "balanced_sample_large": f"""
SELECT doc_id, lang FROM (
  SELECT doc_id, lang,
         row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) AS nth
  FROM documents) x
WHERE nth <= {MANY_PER_LANG}""",
    "preference_metrics": _with(
        SPLIT
        + """,
scored AS (
  SELECT split,
         0.1::DOUBLE * ((-length(chosen) / 100.0::DOUBLE + (length(chosen) + conv_id % 7) / 100.0::DOUBLE)
              - (-length(rejected) / 100.0::DOUBLE
                 + (length(rejected) + conv_id % 5) / 100.0::DOUBLE)) AS m
  FROM splits
)""",
        """SELECT split, count(*) AS n,
       round(avg(CASE WHEN m > 0 THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round(avg(m), 6) AS mean_margin,
       round(avg(CASE WHEN m < 0 THEN -m ELSE 0 END + ln(1 + exp(-abs(m)))), 6) AS mean_loss
FROM scored GROUP BY split""",
    ),
}

ORACLES["streamed_nesting"] = ORACLES["sft_chatml_text"]
ORACLES["parsed_messages"] = _with(
    SPACED_TEXTS,
    """SELECT conv_id, p.pos, p.role, p.text AS content,
       NOT bool_or(contains(p.role || p.text, '<|im_start|>') OR contains(p.role || p.text, '<|im_end|>'))
         OVER (PARTITION BY conv_id) AS clear
FROM pos p JOIN texts USING (conv_id)""",
)
# Units by walking over all pairs of families that share a text.
ORACLES["leak_free_split"] = """
WITH RECURSIVE held AS (
  SELECT DISTINCT doc_id // 2 AS family, text FROM documents WHERE text IS NOT NULL
),
near AS (SELECT DISTINCT a.family AS a, b.family AS b FROM held a JOIN held b USING (text)),
reached AS (
  SELECT a AS family, a AS other FROM near
  UNION
  SELECT r.family, n.b FROM reached r JOIN near n ON n.a = r.other
),
units AS (SELECT family, min(md5(':' || other)) AS unit FROM reached GROUP BY family)
SELECT d.doc_id, coalesce(u.unit, md5(':' || (d.doc_id // 2))) AS unit,
       (SELECT (3 * count(*) + 9) // 10 FROM documents) AS n_eval,
       CAST(0 AS BIGINT) AS n_key_overlap, CAST(0 AS BIGINT) AS n_text_overlap
FROM documents d LEFT JOIN units u ON u.family = d.doc_id // 2"""
ORACLES["token_budget"] = _with(
    SPACED_TEXTS,
    """SELECT conv_id, CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes, true AS begins,
       true AS cut_if_over, true AS fits, true AS plausible FROM texts""",
)
ORACLES["pack_sequences"] = _with(
    SPACED_TEXTS,
    r"""SELECT conv_id, CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS n_tokens,
       true AS follows, true AS fits, true AS few_bins FROM texts""",
)
ORACLES["nested_sharegpt_text"] = f"SELECT text FROM ({ORACLES['sft_sharegpt_text']})"
