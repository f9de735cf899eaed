"""The same results as plain SQL over the same tables, one statement per query."""

from __future__ import annotations

import re

from checks.queries import (
    BUDGET_MINUTES,
    EPOCHS,
    NONFINITE_LIMIT,
    SETTINGS,
    SHAPE,
)

# White space as a strip and as a Unicode regex knows it, as class bodies.
STRIP_CLASS = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
SPACE_CLASS = (
    r"\x{09}-\x{0d}\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

W, B, A, U = SETTINGS.world_size, SETTINGS.batch_size, SETTINGS.accumulation, SETTINGS.max_length
MERGES = SETTINGS.vocab_size - 261
L, SPE, LOG, TOTAL = (
    SHAPE.batches_per_epoch,
    SHAPE.steps_per_epoch,
    SHAPE.logging_steps,
    SHAPE.total_steps,
)


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{STRIP_CLASS}]+|[{STRIP_CLASS}]+$', '', 'g')"


def _not_blank(x: str) -> str:
    return f"regexp_matches({x}, '[^{STRIP_CLASS}]')"


def _words(x: str) -> str:
    """Words without look-ahead: a mark goes before the last blank of a run that a word follows."""
    s = SPACE_CLASS
    marked = f"regexp_replace({x}, '([{s}])([{s}])([^{s}])', '\\1' || chr(1) || '\\2\\3', 'g')"
    pattern = (
        r"''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+"
        rf"| ?[^{s}\p{{L}}\p{{N}}\x{{01}}]+|[{s}]+"
    )
    return f"regexp_extract_all({marked}, '{pattern}')"


def _byte_list(x: str) -> str:
    return f"regexp_extract_all(hex(encode({x})), '..')"


_BYTE_ID = (
    "(5 + CASE WHEN v BETWEEN 33 AND 126 THEN v - 33 WHEN v BETWEEN 161 AND 172 THEN v - 67"
    " WHEN v >= 174 THEN v - 68 WHEN v <= 32 THEN 188 + v WHEN v <= 160 THEN v + 94 ELSE 255 END)"
)


def _byte_id(h: str) -> str:
    return re.sub(r"\bv\b", f"('0x' || {h})::INT", _BYTE_ID)


def _byte_ids(x: str) -> str:
    return f"list_transform({_byte_list(x)}, lambda h: {_byte_id('h')})"


DIRTY = """dirty AS (
  SELECT doc_id, lang, source, text FROM documents UNION ALL
  SELECT -doc_id - 1, lang, source, CASE
    WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 11 = 1 THEN ''
    WHEN doc_id % 11 = 2 OR doc_id BETWEEN 200 AND 399 THEN '   '
    WHEN doc_id % 11 = 3 THEN chr(160) || chr(12288) || chr(9)
    ELSE chr(8203) END
  FROM documents WHERE doc_id % 11 <= 4 OR doc_id BETWEEN 200 AND 399)"""

JSON = """js AS (
  SELECT doc_id, lang, source, json_object('content', text)::VARCHAR AS text FROM documents
  UNION ALL SELECT -doc_id - 1, lang, source, CASE doc_id % 5
    WHEN 0 THEN '{' || text WHEN 1 THEN '{"content": 5}'
    WHEN 2 THEN json_object('other', text)::VARCHAR ELSE '{"content": null}' END
  FROM documents WHERE doc_id % 5 <= 3)"""

CHAT = """chat AS (
  SELECT conv_id, string_agg(
    CASE role WHEN 'system' THEN text || chr(10) WHEN 'user' THEN '<|user|>' || text || '<|end|>'
      ELSE '<|bot|>' || text || '<|end|>' END, '' ORDER BY turn
  ) AS text
  FROM conversations GROUP BY conv_id)"""

CONV = """conv AS (
  SELECT conv_id, list(struct_pack(role := role, content := text) ORDER BY turn) AS c
  FROM conversations GROUP BY conv_id)"""

PHASES = f"""{CHAT}, phases AS (
  SELECT 'pretrain' AS phase, doc_id AS key, text FROM documents
  UNION ALL SELECT 'instruct', conv_id, text FROM chat)"""


def _parse(x: str) -> str:
    parts = f"string_split({x}, '<|end|>')"
    user = _strip(f"replace({parts}[i + 1], '<|user|>', '')")
    bot = _strip(f"replace({parts}[i + 2], '<|bot|>', '')")
    return (
        f"flatten(list_transform(range(0, len({parts}) - 1, 2), lambda i: "
        f"[struct_pack(role := 'user', content := {user}),"
        f" struct_pack(role := 'assistant', content := {bot})]))"
    )


def _render(c: str) -> str:
    return (
        f"'<s>' || array_to_string(list_transform({c}, lambda m: CASE m.role WHEN 'user' THEN"
        " '<|user|>' || chr(10) || m.content || '<|end|>' || chr(10)"
        " ELSE '<|bot|>' || chr(10) || m.content || '<|end|>' || chr(10) || '</s>' END), '')"
    )


def _valid(c: str) -> str:
    return (
        f"len(list_filter({c}, lambda m, i: (m.role = 'user') <> (i % 2 = 1)"
        " OR m.role NOT IN ('user', 'assistant'))) = 0"
    )


PARSED = f"""{PHASES}, prepared AS (
  SELECT phase, key, CASE WHEN phase = 'instruct' AND contains(text, '<|end|>')
    THEN {_render(_parse('text'))} ELSE '<s>' || text || '</s>' END AS text
  FROM phases WHERE {_not_blank('text')})"""

_SPECIAL_PATTERN = r"<s>|<pad>|</s>|<unk>|<mask>|<\|user\|>|<\|bot\|>|<\|end\|>"
_SPECIAL_ID = (
    "CASE k WHEN '<s>' THEN 0 WHEN '<pad>' THEN 1 WHEN '</s>' THEN 2 WHEN '<unk>' THEN 3"
    " WHEN '<mask>' THEN 4 WHEN '<|user|>' THEN %d WHEN '<|bot|>' THEN %d ELSE %d END"
)


def _encoded(base: int) -> str:
    """Byte ids of prepared texts, cut around the special tokens."""
    special = _SPECIAL_ID % (base, base + 1, base + 2)
    return f"""{PARSED}, cut AS (
      SELECT phase, key, string_split_regex(text, '{_SPECIAL_PATTERN}') AS plain,
        regexp_extract_all(text, '{_SPECIAL_PATTERN}') AS marks FROM prepared),
    encoded AS (
      SELECT phase, key, flatten(list_transform(range(1, len(plain) + 1), lambda i:
        list_concat({_byte_ids('plain[i]')},
          list_transform(marks[i:i], lambda k: {special})))) AS ids
      FROM cut)"""


ENCODED = _encoded(261)


def _layout(source: str, keys: str) -> str:
    return f"""shuffled AS (
      SELECT {keys}, epoch, row_number() OVER (PARTITION BY epoch ORDER BY
          md5(concat_ws('-', {SETTINGS.seed} + epoch, {keys})), {keys}) - 1 AS perm_pos,
        count(*) OVER (PARTITION BY epoch) AS n_examples
      FROM {source}, (SELECT unnest(range({EPOCHS})) AS epoch)),
    laid AS (
      SELECT {keys}, epoch, perm_pos % {W} AS rank, perm_pos // {W} AS pos,
        perm_pos // {W} // {B} AS batch_no
      FROM shuffled WHERE perm_pos < n_examples // {W} * {W})"""


def _batches(phase: str) -> str:
    return f"""{ENCODED}, mine AS (
      SELECT key, ids[1:{U}] AS ids FROM encoded WHERE phase = '{phase}'),
    {_layout('mine', 'key')},
    sized AS (
      SELECT key, epoch, rank, batch_no, ids, len(ids) AS n_ids,
        ((max(len(ids)) OVER (PARTITION BY epoch, rank, batch_no) + 7) // 8 * 8) AS pad_to
      FROM laid JOIN mine USING (key)),
    padded AS (
      SELECT * EXCLUDE (ids), list_concat(ids, list_transform(range(pad_to - n_ids), lambda x: 1))
        AS input_ids FROM sized)"""


LABELS = f"""{_batches('instruct')}, flat AS (
      SELECT key, epoch, rank, batch_no, n_ids, pad_to,
        unnest(input_ids) AS id, generate_subscripts(input_ids, 1) AS j FROM padded),
    ended AS (
      SELECT *, coalesce(sum((id = 263)::INT) OVER (PARTITION BY key, epoch ORDER BY j
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS piece FROM flat),
    labelled AS (
      SELECT *, CASE WHEN id <> 263 AND coalesce(max((id = 262)::INT) OVER (
          PARTITION BY key, epoch, piece ORDER BY j
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 THEN id ELSE -100 END AS label
      FROM ended),
    per_row AS (
      SELECT key, epoch, rank, batch_no, any_value(n_ids) AS n_ids,
        any_value(pad_to) AS pad_to, sum((label <> -100)::INT)::BIGINT AS n_kept,
        string_agg(label::VARCHAR, ' ' ORDER BY j) AS labels
      FROM labelled GROUP BY key, epoch, rank, batch_no)"""

PLAN = f"""{PHASES}, plan AS (
      SELECT phase, n_examples, per_epoch, greatest(1, floor({SETTINGS.epochs} * per_epoch)::BIGINT)
        AS total_steps
      FROM (SELECT phase, count(*) AS n_examples,
          greatest(1, ((count(*) // {W} + {B} - 1) // {B}) // {A}) AS per_epoch
        FROM phases WHERE {_not_blank('text')} GROUP BY phase))"""

STEPS = f"""{PLAN}, steps AS (
      SELECT phase, per_epoch, total_steps, unnest(range(1, total_steps + 1)) AS step FROM plan)"""

# Words of both phases; only those of the documents count in training.
BPE = f"""{PARSED}, raw_words AS (
      SELECT unnest({_words('text')}) AS word, 1 AS n FROM documents
      UNION ALL SELECT unnest(flatten(list_transform(
        string_split_regex(text, '{_SPECIAL_PATTERN}'), lambda p: {_words('p')}))), 0 FROM prepared),
    counted AS (SELECT word, sum(n)::BIGINT AS n FROM raw_words GROUP BY word),
    base AS (
      SELECT v, {_BYTE_ID} AS id, CASE WHEN {_BYTE_ID} < 193 THEN chr(v)
        ELSE chr(256 + {_BYTE_ID} - 193) END AS token
      FROM (SELECT unnest(range(256))::INT AS v)),
    start AS (
      SELECT word, n, array_to_string(list_transform({_byte_ids('word')},
        lambda t: chr((256 + t)::INT)), '') AS sym FROM counted)"""

MERGED = f"""t(step, kind, word, n, a) AS (
      SELECT 0, 'w', word, n, sym FROM start
      UNION ALL SELECT 0, 'd', token, 0, chr((256 + id)::INT) FROM base
      UNION ALL (
        WITH pairs AS (
          SELECT unnest(list_transform(range(1, len(a)), lambda i: substr(a, i, 2))) AS p, n
          FROM t WHERE kind = 'w' AND n > 0),
        best AS (
          SELECT p, sum(n)::BIGINT AS c FROM pairs GROUP BY p HAVING sum(n) >= 2
          ORDER BY c DESC, p LIMIT 1),
        now AS (SELECT max(step) AS s FROM t),
        named AS (
          SELECT p, c, s, chr((256 + 261 + s)::INT) AS x,
            (SELECT any_value(word) FROM t WHERE kind = 'd' AND a = substr(p, 1, 1)) AS l,
            (SELECT any_value(word) FROM t WHERE kind = 'd' AND a = substr(p, 2, 1)) AS r
          FROM best, now WHERE s < {MERGES})
        SELECT step + 1, kind, word, n, CASE kind WHEN 'w' THEN replace(a, p, x) ELSE a END
        FROM t, named WHERE kind IN ('w', 'd')
        UNION ALL SELECT s + 1, 'd', l || r, 0, x FROM named
        UNION ALL SELECT s + 1, 'm', l || chr(2) || r, c, x FROM named)),
    last AS (SELECT max(step) AS s FROM t),
    vocab AS (
      SELECT unicode(a) - 256 AS id, word AS token, false AS special
      FROM t, last WHERE kind = 'd' AND step = s
      UNION ALL SELECT unnest([0, 1, 2, 3, 4]),
        unnest(['<s>', '<pad>', '</s>', '<unk>', '<mask>']), true),
    word_ids AS (
      SELECT word, n, list_transform(string_split(a, ''), lambda x: unicode(x) - 256) AS ids
      FROM t, last WHERE kind = 'w' AND step = s)"""

TRAINED = f"WITH RECURSIVE {BPE}, {MERGED}"

# Of the ids of bytes, those shown by a character from 256 on.
PAIRED = f"""WITH w AS (
        SELECT {_byte_list('word')} AS b, word, count(*) AS n FROM (
          SELECT unnest({_words('text')}) AS word FROM documents) GROUP BY word),
      p AS (SELECT unnest(list_transform(range(1, len(b)), lambda i:
        struct_pack(l := b[i], r := b[i + 1]))) AS pair, n FROM w),
      counted AS (SELECT pair.l AS l, pair.r AS r, sum(n) AS n FROM p GROUP BY 1, 2 HAVING sum(n) > 1),
      bytes AS (SELECT printf('%02X', v) AS hex, {_BYTE_ID} AS id, CASE WHEN {_BYTE_ID} < 193
        THEN chr(v) ELSE chr(256 + {_BYTE_ID} - 193) END AS token
        FROM (SELECT unnest(range(256))::INT AS v)),
      vocab AS (
        SELECT unnest([0, 1, 2, 3, 4]) AS id,
          unnest(['<s>', '<pad>', '</s>', '<unk>', '<mask>']) AS token, true AS special
        UNION ALL SELECT id, token, false FROM bytes
        UNION ALL SELECT 260 + row_number() OVER (ORDER BY n DESC, l, r), a.token || b.token, false
          FROM counted JOIN bytes a ON a.hex = l JOIN bytes b ON b.hex = r)"""

METRICS = """m AS (
      SELECT user_id AS run_id,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS micro,
        epoch_us(ts) AS ts_us,
        CASE WHEN event_type = 'error' THEN 'nan'::DOUBLE ELSE value END AS loss
      FROM events)"""

STEPPED = f"""{METRICS}, st AS (
      SELECT *, micro // {L} AS epoch,
        micro // {L} * {SPE} + micro % {L} // {A} + 1 AS step,
        (micro % {L} + 1) % {A} = 0 AS closes, isfinite(loss) AS ok
      FROM m)"""

STREAKS = f"""{METRICS}, streaks AS (
      SELECT *, micro - coalesce(max(CASE WHEN isfinite(loss) THEN micro END) OVER (
        PARTITION BY run_id ORDER BY micro), -1) AS streak FROM m),
    aborts AS (
      SELECT run_id, min(micro) AS abort_micro, arg_min(streak, micro) AS streak
      FROM streaks WHERE streak >= {NONFINITE_LIMIT} GROUP BY run_id)"""



def _ordered_sum(value: str, place: str, where: str) -> str:
    return f"list_reduce(list({value} ORDER BY {place}) FILTER ({where}), lambda a, b: a + b)"


WINDOWS = f"""{STEPPED}, win AS (
      SELECT run_id, (step - 1) // {LOG} AS w, ((step - 1) // {LOG} + 1) * {LOG} AS step,
        max(CASE WHEN closes AND step % {LOG} = 0 THEN ts_us END) AS end_us,
        count(CASE WHEN ok THEN 1 END) AS n_finite, {_ordered_sum('loss', 'micro', 'ok')} AS total
      FROM st GROUP BY run_id, (step - 1) // {LOG}),
    emitted AS (
      SELECT *, total / n_finite AS mean_loss FROM win
      WHERE n_finite > 0 AND end_us IS NOT NULL)"""

HISTORY = f"""{STEPPED}, history AS (
      SELECT run_id, CASE run_id % 14 WHEN 7 THEN 'custom-' || run_id ELSE sha256('run-' || run_id)
          END AS state_key,
        CASE run_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'run-other' ELSE 'run-' || run_id END
          AS stamped_owner,
        max(step) AS global_step, max(step) >= {TOTAL} AS completed, max(ts_us) AS updated_at
      FROM st WHERE closes GROUP BY run_id, epoch),
    latest AS (
      SELECT * FROM history
      QUALIFY row_number() OVER (PARTITION BY state_key ORDER BY updated_at DESC) = 1)"""

RESUMED = f"""{PLAN}, {HISTORY}, runs AS (SELECT DISTINCT user_id AS run_id FROM events),
    resumed AS (
      SELECT runs.run_id AS run_id, coalesce(global_step, 0)::BIGINT AS global_step,
        CASE runs.run_id % 2 WHEN 1 THEN 'instruct' ELSE 'pretrain' END AS phase
      FROM runs LEFT JOIN latest ON runs.run_id = latest.run_id
      WHERE latest.run_id IS NULL OR runs.run_id % 14 = 7
        OR stamped_owner = 'run-' || runs.run_id)"""

SUMMARY = f"""{STEPPED}, blocks AS (
      SELECT run_id, micro // 1024 AS block, count(*) AS n_micro,
        count(CASE WHEN ok THEN 1 END) AS n_finite, max(CASE WHEN closes THEN step END) AS last_step,
        {_ordered_sum('loss', 'micro', 'ok')} AS part
      FROM st GROUP BY run_id, micro // 1024),
    summary AS (
      SELECT run_id, sum(n_micro)::BIGINT AS n_micro, sum(n_finite)::BIGINT AS n_finite,
        coalesce(max(last_step), 0) AS global_step,
        {_ordered_sum('part', 'block', 'part IS NOT NULL')} AS total
      FROM blocks GROUP BY run_id)"""

STOPS = f"""{STEPPED}, starts AS (SELECT run_id, min(ts_us) AS start_us FROM m GROUP BY run_id),
    stops AS (
      SELECT run_id, min(CASE WHEN step % 10 = 0
          AND (ts_us - start_us) / 60000000.0 >= {BUDGET_MINUTES} THEN step END) AS stop_step,
        coalesce(max(step), 0) AS last_step,
        greatest(0.0, {BUDGET_MINUTES} - coalesce(max((ts_us - start_us) / 60000000.0), 0.0))
          AS remaining_minutes
      FROM starts LEFT JOIN (SELECT * FROM st WHERE closes) USING (run_id) GROUP BY run_id),
    verdicts AS (
      SELECT run_id, least(last_step, coalesce(stop_step, last_step), {TOTAL}) AS final_step,
        coalesce(stop_step <= least(last_step, stop_step, {TOTAL}), false) AS stopped_early
      FROM stops),
    done AS (
      SELECT *, NOT stopped_early AND final_step >= {TOTAL} AS completed FROM verdicts)"""

_ORACLES: dict[str, str] = {
    "scan_phase": f"WITH {PHASES} SELECT phase, key, text FROM phases",
    "stream_prepare": f"SELECT doc_id, '<s>' || {_strip('text')} || '</s>' AS text FROM documents"
    f" WHERE {_not_blank('text')}",
    "prepare_roundtrip": f"WITH {PARSED} SELECT phase, key, text FROM prepared",
    "prepared_report": f"WITH {DIRTY} SELECT source, lang, count(*) AS n_examples,"
    " sum(length(text) + 7)::BIGINT AS n_chars, max(length(text) + 7) AS longest"
    f" FROM dirty WHERE {_not_blank('text')} GROUP BY source, lang",
    "run_report": f"""{PAIRED}, {PARSED} SELECT phase, count(*) AS n_examples,
        sum(length(text))::BIGINT AS n_chars, max(length(text)) AS longest,
        (SELECT count(*) FROM vocab) AS vocab_size FROM prepared GROUP BY phase""",
    "vocab_roundtrip": f"{TRAINED} SELECT id::BIGINT AS id, token, special FROM vocab",
    "run_state_latest": f"WITH {HISTORY} SELECT state_key, coalesce(stamped_owner, 'none') AS"
    " stamped_owner, global_step, completed, updated_at FROM latest",
    "run_state_guard": f"""WITH {HISTORY}, ids AS (
        SELECT user_id AS id FROM events UNION SELECT c_custkey FROM customer),
      expected AS (SELECT 'run-' || id AS owner, CASE id % 14 WHEN 7 THEN 'custom-' || id
          ELSE sha256('run-' || id) END AS state_key, id % 14 = 7 AS custom FROM ids)
      SELECT owner, CASE WHEN latest.state_key IS NULL THEN 'new'
          WHEN custom OR stamped_owner = owner THEN 'ours'
          WHEN stamped_owner IS NULL THEN 'missing' ELSE 'foreign' END AS verdict,
        coalesce(global_step, 0)::BIGINT AS resume_step
      FROM expected LEFT JOIN latest ON expected.state_key = latest.state_key""",
    "run_state_close": f"""WITH {HISTORY}, summed AS (
        SELECT run_id, coalesce(max(CASE WHEN closes THEN step END), 0) AS s FROM st GROUP BY run_id)
      SELECT state_key, global_step FROM latest JOIN summed USING (run_id)
      WHERE NOT (run_id % 2 = 1 AND s >= {TOTAL} AND run_id % 3 <> 0)""",
    "filter_blank": f"WITH {DIRTY} SELECT doc_id, text FROM dirty WHERE {_not_blank('text')}",
    "drop_null_results": f"""WITH {JSON} SELECT doc_id, CASE WHEN doc_id < 0 THEN ''
        ELSE '<s>' || json_extract_string(text, '$.content') || '</s>' END AS result
      FROM js WHERE doc_id >= 0 OR (-doc_id - 1) % 5 = 1""",
    "quarantine_counts": f"""WITH {DIRTY}, {JSON}, everything AS (
        SELECT doc_id, lang, text, false AS plain FROM js
        UNION ALL SELECT doc_id, lang, text, true FROM dirty),
      read AS (
        SELECT lang, coalesce({_not_blank('text')}, false) AS filled, CASE
          WHEN plain OR NOT coalesce(json_valid(text), false) THEN false
          ELSE coalesce(json_type(text, '$.content') = 'VARCHAR', false) END AS good
        FROM everything)
      SELECT processor, CASE WHEN NOT filled THEN 'blank' WHEN good THEN 'ok'
          WHEN processor = 'sql' THEN 'null_result' ELSE 'error' END AS outcome,
        lang, count(*) AS n
      FROM read, (VALUES ('native'), ('sql'), ('python')) AS p(processor) GROUP BY ALL""",
    "rejected_rows": f"""WITH {DIRTY}, {JSON}, everything AS (
        SELECT doc_id, lang, text, false AS plain FROM js
        UNION ALL SELECT doc_id, lang, text, true FROM dirty),
      read AS (
        SELECT doc_id, lang, coalesce({_not_blank('text')}, false) AS filled, CASE
          WHEN plain OR NOT coalesce(json_valid(text), false) THEN false
          ELSE coalesce(json_type(text, '$.content') = 'VARCHAR', false) END AS good
        FROM everything)
      SELECT 'pretrain' AS phase, doc_id, lang,
        CASE WHEN filled THEN 'null_result' ELSE 'blank' END AS reject_reason
      FROM read WHERE NOT (filled AND good)""",
    "stream_rejected": f"""SELECT 0::BIGINT AS batch, doc_id, text,
        CASE WHEN coalesce({_not_blank('text')}, false) THEN 'null_result' ELSE 'blank' END AS reject_reason
      FROM documents WHERE NOT coalesce({_not_blank('text')} AND contains(text, chr(10)), false)""",
    "empty_batches": f"""WITH {DIRTY}, numbered AS (
        SELECT (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS batch_no,
          coalesce({_not_blank('text')}, false) AS ok FROM dirty)
      SELECT batch_no, count(*) AS n_rows, sum(ok::INT)::BIGINT AS n_valid
      FROM numbered GROUP BY batch_no HAVING sum(ok::INT) = 0""",
    "strip_unicode": "SELECT doc_id, " + _strip(
        "(chr(12288) || chr(9) || ' ' || text || ' ' || chr(10) || chr(28) || chr(160))"
    ) + " AS stripped FROM documents",
    "format_pretrain": f"WITH {DIRTY} SELECT doc_id, '<s>' || text || '</s>' AS text FROM dirty"
    f" WHERE {_not_blank('text')}",
    "format_strip_wrap": f"WITH {DIRTY} SELECT doc_id, '<s>' || {_strip('text')} || '</s>' AS text"
    f" FROM dirty WHERE {_not_blank('text')}",
    "format_json": f"""WITH {JSON} SELECT doc_id,
        '<s>' || json_extract_string(text, '$.content') || '</s>' AS text
      FROM (SELECT * FROM js WHERE json_valid(text))
      WHERE json_type(text, '$.content') = 'VARCHAR'""",
    "split_parts": f"""WITH {CHAT}, p AS (
        SELECT conv_id, string_split(text, '<|end|>') AS parts FROM chat)
      SELECT conv_id, generate_subscripts(parts, 1) - 1 AS part_no,
        unnest(parts) AS part FROM p""",
    "parse_conversation": f"""WITH {CHAT} SELECT conv_id, array_to_string(list_transform(
        {_parse('text')}, lambda m: m.role || chr(2) || m.content), chr(3)) AS dialogue FROM chat""",
    "render_chat": f"WITH {CONV} SELECT conv_id, {_render('c')} AS prompt FROM conv"
    f" WHERE {_valid('c')}",
    "chat_role_audit": f"""WITH {CONV} SELECT conv_id, sum(len(c))::BIGINT AS n_messages,
        bool_and({_valid('c')}) AS valid FROM conv GROUP BY conv_id""",
    "format_instruct": f"""WITH {PHASES} SELECT phase, key,
        CASE WHEN contains(text, '<|end|>') THEN {_render(_parse('text'))}
          ELSE '<s>' || text || '</s>' END AS text
      FROM phases WHERE {_not_blank('text')}""",
    "format_line_chat": f"""WITH lines AS (
        SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x, i:
          struct_pack(role := CASE i % 2 WHEN 1 THEN 'user' ELSE 'assistant' END, content := x)),
          lambda m: {_not_blank('m.content')}) AS c
        FROM documents WHERE {_not_blank('text')})
      SELECT doc_id, {_render('c')} AS text FROM lines WHERE {_valid('c')}""",
    "pretokenize": f"""SELECT doc_id, len({_words('text')})::BIGINT AS n_words,
        array_to_string({_words('text')}, chr(3)) AS words FROM documents""",
    "word_counts": f"""WITH {DIRTY} SELECT word, count(*) AS n FROM (
        SELECT unnest({_words('text')}) AS word FROM dirty WHERE {_not_blank('text')})
      GROUP BY word""",
    "byte_histogram": f"""SELECT byte, count(*) AS n FROM (
        SELECT unnest({_byte_list('text')}) AS byte FROM documents) GROUP BY byte""",
    "bpe_pair_counts": f"""WITH w AS (
        SELECT {_byte_list('word')} AS b, count(*) AS n FROM (
          SELECT unnest({_words('text')}) AS word FROM documents) GROUP BY word),
      p AS (SELECT unnest(list_transform(range(1, len(b)), lambda i:
        struct_pack(l := b[i], r := b[i + 1]))) AS pair, n FROM w)
      SELECT pair.l AS "left", pair.r AS "right", sum(n)::BIGINT AS n FROM p GROUP BY 1, 2""",
    "bpe_train": f"""{TRAINED} SELECT (step - 1)::BIGINT AS rank,
        string_split(word, chr(2))[1] AS "left", string_split(word, chr(2))[2] AS "right",
        replace(word, chr(2), '') AS merged FROM t WHERE kind = 'm'""",
    "bpe_first_merges": f"""{TRAINED} SELECT (step - 1)::BIGINT AS rank,
        string_split(word, chr(2))[1] AS "left", string_split(word, chr(2))[2] AS "right",
        replace(word, chr(2), '') AS merged FROM t WHERE kind = 'm'""",
    "pair_vocab_layout": f"{PAIRED} SELECT id::BIGINT AS id, token, special FROM vocab",
    "pair_vocab_sizes": f"""{PAIRED} SELECT stage, (count(*) + extra)::BIGINT AS n_tokens,
        sum((NOT special)::INT)::BIGINT AS n_plain
      FROM vocab, (VALUES ('trained', 0), ('pretrain', 0), ('instruct', 3)) AS s(stage, extra)
      GROUP BY stage, extra""",
    "pair_extend_vocab": f"""{PAIRED} SELECT id::BIGINT AS id, token, special FROM vocab
      UNION ALL SELECT (SELECT max(id) FROM vocab) + ord, token, true
      FROM (VALUES (1, '<|user|>'), (2, '<|bot|>'), (3, '<|end|>')) AS x(ord, token)""",
    "pair_token_ids": f"""{PAIRED} SELECT word AS name, word AS token, id::BIGINT AS id
      FROM w JOIN vocab ON token = word WHERE regexp_full_match(word, '[A-Za-z]+')""",
    "vocab_layout": f"{TRAINED} SELECT id::BIGINT AS id, token, special FROM vocab",
    "vocab_sizes": f"""{TRAINED} SELECT stage, (count(*) + extra)::BIGINT AS n_tokens,
        sum((NOT special)::INT)::BIGINT AS n_plain
      FROM vocab, (VALUES ('trained', 0), ('pretrain', 0), ('instruct', 3)) AS s(stage, extra)
      GROUP BY stage, extra""",
    "extend_vocab": f"""{TRAINED} SELECT id::BIGINT AS id, token, special FROM vocab
      UNION ALL SELECT (SELECT max(id) FROM vocab) + ord, token, true
      FROM (VALUES (1, '<|user|>'), (2, '<|bot|>'), (3, '<|end|>')) AS x(ord, token)""",
    "token_ids": f"""{TRAINED} SELECT name, token, ((SELECT max(id) FROM vocab) + ord)::BIGINT AS id
      FROM (VALUES ('user', 1, '<|user|>'), ('assistant', 2, '<|bot|>'), ('bot', 2, '<|bot|>'),
        ('end', 3, '<|end|>')) AS x(name, ord, token)
      UNION ALL SELECT word, word, id::BIGINT FROM word_ids JOIN vocab ON token = word
      WHERE n > 0 AND regexp_full_match(word, '[A-Za-z]+')""",
    "instruct_audit": f"""WITH words AS (
        SELECT DISTINCT source, word FROM (
          SELECT source, unnest({_words('text')}) AS word FROM documents)
        WHERE word IN (' heitachte', ' inthe', ' para')),
      names AS (
        SELECT source AS tokenizer, regexp_extract(source, '[0-9]+')::INT % 4 < 2 AS t,
          (SELECT count(*) FROM words WHERE words.source = d.source) = 3 AS w
        FROM (SELECT DISTINCT source FROM documents) AS d)
      SELECT tokenizer, t AS has_template, w AS has_tokens, t AND w AS ready,
        CASE WHEN t AND w THEN 'ready' WHEN t THEN 'template without tokens'
          WHEN w THEN 'tokens without template' ELSE 'not configured' END AS outcome
      FROM names""",
    "encode_bytes": f"WITH {ENCODED} SELECT phase, key,"
    " array_to_string(ids, ' ') AS ids FROM encoded",
    "encode_bpe": f"""{TRAINED}, cut AS (
        SELECT phase, key, string_split_regex(text, '{_SPECIAL_PATTERN}') AS plain,
          regexp_extract_all(text, '{_SPECIAL_PATTERN}') AS marks FROM prepared),
      listed AS (
        SELECT phase, key, flatten(list_transform(range(1, len(plain) + 1), lambda i:
          list_concat({_words('plain[i]')}, marks[i:i]))) AS words FROM cut),
      placed AS (
        SELECT phase, key, unnest(words) AS word, generate_subscripts(words, 1) AS j
        FROM listed),
      mapping AS (
        SELECT word, ids FROM word_ids
        UNION ALL SELECT k, [{_SPECIAL_ID % (SETTINGS.vocab_size, SETTINGS.vocab_size + 1, SETTINGS.vocab_size + 2)}]
        FROM (SELECT unnest(['<s>', '<pad>', '</s>', '<unk>', '<mask>', '<|user|>', '<|bot|>',
          '<|end|>']) AS k))
      SELECT phase, key, sum(len(ids))::BIGINT AS n_ids,
        string_agg(array_to_string(ids, ' '), ' ' ORDER BY j) AS ids
      FROM placed JOIN mapping USING (word) GROUP BY phase, key""",
    "word_tokens": f"{TRAINED} SELECT word, n, array_to_string(ids, ' ') AS ids FROM word_ids"
    " WHERE n > 0",
    "truncate_ids": f"""WITH {ENCODED} SELECT key, len(ids[1:{U}])::BIGINT AS n_ids,
        array_to_string(ids[1:{U}], ' ') AS ids FROM encoded WHERE phase = 'pretrain'""",
    "pad_batches": f"""WITH {_batches('pretrain')} SELECT key, epoch, rank, batch_no, n_ids,
        pad_to, md5(array_to_string(input_ids, ' ')) AS input_ids,
        md5(array_to_string(list_transform(range(pad_to), lambda x:
          CASE WHEN x < n_ids THEN 1 ELSE 0 END), ' ')) AS attention_mask FROM padded""",
    "labels_pretrain": f"""WITH {_batches('pretrain')} SELECT key, epoch, rank, batch_no,
        md5(array_to_string(input_ids, ' ')) AS labels FROM padded""",
    "mask_user_tokens": f"WITH {LABELS} SELECT key, epoch, rank, batch_no, labels"
    " FROM per_row",
    "supervision_stats": f"""WITH {LABELS} SELECT epoch, rank, batch_no, count(*) AS n_examples,
        sum(n_ids)::BIGINT AS n_tokens, sum(pad_to - n_ids)::BIGINT AS n_pads,
        sum(n_kept)::BIGINT AS n_kept, round(sum(n_kept) / sum(pad_to)::DOUBLE, 9) AS kept_share
      FROM per_row GROUP BY epoch, rank, batch_no""",
    "epoch_shuffle": f"""WITH {DIRTY}, d AS (SELECT doc_id FROM dirty WHERE {_not_blank('text')}),
      {_layout('d', 'doc_id')} SELECT doc_id, epoch, perm_pos, n_examples FROM shuffled""",
    "shard_layout": f"""WITH {DIRTY}, d AS (SELECT doc_id FROM dirty WHERE {_not_blank('text')}),
      {_layout('d', 'doc_id')} SELECT doc_id, epoch, rank, pos FROM laid""",
    "micro_batches": f"""WITH {DIRTY}, d AS (SELECT doc_id FROM dirty WHERE {_not_blank('text')}),
      {_layout('d', 'doc_id')} SELECT epoch, rank, batch_no, count(*) AS n_rows,
        min(doc_id) AS low, max(doc_id) AS high FROM laid GROUP BY epoch, rank, batch_no""",
    "batch_numbers": f"""WITH {DIRTY}, d AS (
        SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos
        FROM dirty WHERE {_not_blank('text')})
      SELECT doc_id, pos // 100 AS format_batch, pos // 1000 AS corpus_batch FROM d""",
    "step_plan": f"""WITH {STEPS} SELECT phase, step, (step - 1) // per_epoch AS epoch,
        (step - 1) % per_epoch * {A} AS first_batch, (step - 1) % per_epoch * {A} + {A} - 1
          AS last_batch FROM steps""",
    "assign_steps": f"""WITH {PLAN}, s AS (
        SELECT phase, key, epoch, row_number() OVER (PARTITION BY phase, epoch ORDER BY
            md5(concat_ws('-', {SETTINGS.seed} + epoch, key)), key) - 1 AS p,
          count(*) OVER (PARTITION BY phase, epoch) AS n
        FROM phases, (SELECT unnest(range({EPOCHS})) AS epoch) WHERE {_not_blank('text')}),
      l AS (SELECT *, p % {W} AS rank, p // {W} // {B} AS batch_no FROM s WHERE p < n // {W} * {W}),
      x AS (SELECT l.*, epoch * per_epoch + batch_no // {A} + 1 AS step, total_steps
        FROM l JOIN plan USING (phase))
      SELECT phase, key, epoch, rank, batch_no, step, (batch_no + 1) % {A} = 0 AS closes
      FROM x WHERE step <= total_steps""",
    "plan_guard": f"""WITH {DIRTY}, g AS (
        SELECT source || '/' || lang AS phase, count(*) AS n_examples,
          (count(*) // 4 + 3) // 4 AS n_batches
        FROM dirty WHERE {_not_blank('text')} GROUP BY 1)
      SELECT *, CASE WHEN n_batches = 0 THEN 'empty' WHEN n_batches < 2 THEN 'no_step' ELSE 'ok' END
        AS status FROM g""",
    "resume_plan": f"""WITH {RESUMED}
      SELECT 'run-' || run_id AS owner, plan.phase AS phase, global_step,
        global_step // per_epoch AS epoch, 0::BIGINT AS batch_no, global_step + 1 AS next_step,
        greatest(0, total_steps - global_step) AS steps_left
      FROM resumed JOIN plan ON plan.phase = resumed.phase""",
    "remaining_steps": f"""WITH {RESUMED}, left_over AS (
        SELECT run_id, plan.phase AS phase, per_epoch,
          unnest(range(global_step + 1, total_steps + 1)) AS step
        FROM resumed JOIN plan ON plan.phase = resumed.phase)
      SELECT 'run-' || run_id AS owner, phase, step, (step - 1) // per_epoch AS epoch,
        (step - 1) % per_epoch * {A} AS first_batch, (step - 1) % per_epoch * {A} + {A} - 1
          AS last_batch FROM left_over""",
    "lr_plan": f"""WITH {STEPS}, r AS (SELECT phase, step, total_steps AS t,
          unnest([step - 1, step]) AS pos, unnest(['lr', 'next_lr']) AS name FROM steps),
      f AS (SELECT phase, step, name, CASE WHEN pos < 10 THEN pos / 10.0::DOUBLE ELSE greatest(0.0,
          0.5 * (1.0 + cos(pi() * (pos - 10) / greatest(1, t - 10)::DOUBLE))) END AS v FROM r)
      SELECT phase, step, round(max(CASE name WHEN 'lr' THEN v END), 9) AS lr,
        round(max(CASE name WHEN 'next_lr' THEN v END), 9) AS next_lr FROM f GROUP BY phase, step""",
    "token_budget": f"""WITH {LABELS}, plan AS (
        SELECT per_epoch, greatest(1, floor({SETTINGS.epochs} * per_epoch)::BIGINT) AS total_steps
        FROM (SELECT greatest(1, ((count(*) // {W} + {B} - 1) // {B}) // {A}) AS per_epoch
          FROM mine)),
      s AS (SELECT per_row.*, epoch * per_epoch + batch_no // {A} + 1 AS step, total_steps
        FROM per_row, plan)
      SELECT 'instruct' AS phase, epoch, step, count(*) AS n_examples,
        {W * B * A}::BIGINT AS effective_batch, sum(n_ids)::BIGINT AS n_tokens,
        sum(pad_to)::BIGINT AS n_padded, sum(n_kept)::BIGINT AS n_kept
      FROM s WHERE step <= total_steps GROUP BY epoch, step""",
    "token_budget_rollup": f"""WITH {LABELS}, plan AS (
        SELECT per_epoch, greatest(1, floor({SETTINGS.epochs} * per_epoch)::BIGINT) AS total_steps
        FROM (SELECT greatest(1, ((count(*) // {W} + {B} - 1) // {B}) // {A}) AS per_epoch
          FROM mine)),
      s AS (SELECT 'instruct' AS phase, per_row.*, epoch * per_epoch + batch_no // {A} + 1 AS step,
          total_steps
        FROM per_row, plan)
      SELECT CASE WHEN grouping(rank) = 0 THEN 'rank' WHEN grouping(step) = 0 THEN 'step'
          WHEN grouping(epoch) = 0 THEN 'epoch' WHEN grouping(phase) = 0 THEN 'phase' ELSE 'total' END
          AS level,
        phase, epoch::BIGINT AS epoch, step, rank::BIGINT AS rank, count(*) AS n_examples,
        {W * B * A}::BIGINT AS effective_batch, sum(n_ids)::BIGINT AS n_tokens,
        sum(pad_to)::BIGINT AS n_padded, sum(n_kept)::BIGINT AS n_kept
      FROM s WHERE step <= total_steps GROUP BY GROUPING SETS (
        (phase, epoch, step, rank), (phase, epoch, step), (phase, epoch), (phase), ())""",
    "finite_loss": f"WITH {METRICS} SELECT run_id, micro, loss FROM m WHERE isfinite(loss)",
    "nonfinite_streaks": f"WITH {STREAKS} SELECT run_id, micro, streak FROM streaks",
    "abort_points": f"WITH {STREAKS} SELECT run_id, abort_micro, streak FROM aborts",
    "before_abort": f"""WITH {STREAKS} SELECT m.run_id AS run_id, count(*) AS n_micro,
        max(m.micro) AS last_micro FROM m LEFT JOIN aborts ON m.run_id = aborts.run_id
      WHERE abort_micro IS NULL OR m.micro <= abort_micro GROUP BY m.run_id""",
    "stream_abort_keyed": f"WITH {STREAKS} SELECT run_id, abort_micro, streak FROM aborts",
    "stream_abort": f"WITH {STREAKS} SELECT run_id, abort_micro, streak FROM aborts",
    "log_windows": f"""WITH {WINDOWS} SELECT run_id, step, round(mean_loss, 9) AS mean_loss, n_finite
      FROM emitted""",
    "throughput": f"""WITH {WINDOWS}, starts AS (
        SELECT run_id, min(ts_us) AS start_us FROM m GROUP BY run_id),
      e AS (SELECT run_id, step, (end_us - coalesce(lag(end_us) OVER (
          PARTITION BY run_id ORDER BY w), start_us)) / 1000000.0 AS elapsed
        FROM emitted JOIN starts USING (run_id))
      SELECT run_id, step, round(elapsed, 6) AS elapsed,
        round(CASE WHEN elapsed > 0 THEN {LOG} / elapsed ELSE 0 END, 9) AS steps_per_second,
        round(CASE WHEN elapsed > 0 THEN {LOG} / elapsed ELSE 0 END * {W * B * A}, 9)
          AS samples_per_second FROM e""",
    "metrics_report": f"""WITH {WINDOWS}, scaled AS (
        SELECT run_id, (step - 1) // {LOG} AS w,
          {_ordered_sum('loss / 10000', 'micro', 'ok')} / count(CASE WHEN ok THEN 1 END) AS loss
        FROM st GROUP BY run_id, (step - 1) // {LOG}),
      starts AS (SELECT run_id, min(ts_us) AS start_us FROM m GROUP BY run_id),
      e AS (SELECT run_id, w, step, (end_us - coalesce(lag(end_us) OVER (
          PARTITION BY run_id ORDER BY w), start_us)) / 1000000.0 AS elapsed
        FROM emitted JOIN starts USING (run_id)),
      r AS (SELECT run_id, step, loss,
          CASE WHEN elapsed > 0 THEN {LOG} / elapsed ELSE 0 END AS speed,
          3e-4::DOUBLE * greatest(0.0, 0.5 * (1.0 + cos(pi() * step / {TOTAL}.0::DOUBLE))) AS lr
        FROM e JOIN scaled USING (run_id, w) WHERE step % {LOG * 2} = 0)
      SELECT run_id, step, 'Step ' || step || '/{TOTAL}' || chr(10)
        || 'loss: ' || CASE WHEN loss <> 0 AND abs(loss) < 0.01
          THEN printf('%.2e', loss) ELSE printf('%.4f', loss) END
        || ' | learning_rate: ' || CASE WHEN lr <> 0 AND abs(lr) < 0.01
          THEN printf('%.2e', lr) ELSE printf('%.4f', lr) END || ' | step: ' || step || chr(10)
        || 'Speed: ' || printf('%.2f', speed * {W * B * A}) || ' samples/s | '
        || printf('%.2f', speed) || ' steps/s' AS report
      FROM r""",
    "run_summary": f"""WITH {SUMMARY} SELECT run_id, n_micro, n_finite, global_step,
        round(coalesce(total, 0) / greatest(1, global_step), 9) AS training_loss,
        round(total / n_finite, 9) AS mean_micro_loss FROM summary""",
    "epoch_times": f"""WITH {STEPPED} SELECT run_id, epoch, count(*) AS n_micro,
        round((max(ts_us) - min(ts_us)) / 60000000.0, 6) AS minutes FROM st GROUP BY run_id, epoch""",
    "stop_points": f"""WITH {STOPS} SELECT run_id, coalesce(stop_step, -1) AS stop_step, last_step,
        round(remaining_minutes, 6) AS remaining_minutes FROM stops""",
    "run_verdicts": f"WITH {STOPS} SELECT run_id, final_step, stopped_early, completed FROM done",
    "next_phase": f"""WITH {STOPS} SELECT run_id, run_id % 2 = 1 AS instruct, completed,
        run_id % 2 = 1 OR completed AS next_instruct,
        CASE WHEN completed AND run_id % 2 = 0 THEN false
          ELSE run_id % 3 = 0 OR NOT completed END AS next_resume,
        completed AND run_id % 2 = 1 AS paused FROM done""",
    "failure_triage": """WITH log AS (
        SELECT CASE WHEN k < 20 THEN 'Connection RESET by peer'
          WHEN k < 35 THEN 'Read Timeout after 30s' WHEN k < 50 THEN '429: too many Requests'
          WHEN k < 60 THEN 'Broken pipe' WHEN k < 80 THEN 'value error in row'
          ELSE 'loss diverged' END AS message
        FROM (SELECT json_extract_string(props, '$.k')::INT AS k FROM events
          WHERE event_type = 'error'))
      SELECT message, count(*) AS n, regexp_matches(lower(message),
        'timeout|max|requests|reset|refused|broken') AS recoverable FROM log GROUP BY message""",
    "custom_processor_sql": f"""WITH {DIRTY} SELECT doc_id,
        '<s>' || replace(text, chr(10), ' ') || '</s>' AS text
      FROM dirty WHERE {_not_blank('text')} AND contains(text, chr(10))""",
    "custom_processor_py": f"""WITH {DIRTY}, s AS (
        SELECT doc_id, string_split(text, chr(10)) AS lines FROM dirty WHERE {_not_blank('text')})
      SELECT doc_id, '<s>' || {_strip('lines[len(lines)]')} || '</s>' AS text
      FROM s WHERE len(lines) > 1 AND len(lines) % 5 <> 0""",
}


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)
