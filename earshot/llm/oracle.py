"""DuckDB SQL for those queries of the subpackage that SQL can express."""

from __future__ import annotations

from earshot.llm import chat_format, licenses, mixing, quality_rules
from earshot.llm.common import sql_list
from earshot.llm.queries import MIX_OTHER, MIX_SEED, MIX_WEIGHTS

_WORD = r"[^\x20\x09-\x0D]+"


def op1() -> str:
    stop = sql_list(sorted(set(quality_rules.STOP_WORDS)))
    return rf"""
    WITH words AS (
        SELECT doc_id, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)),
                           lambda x: regexp_matches(x, '{_WORD}')) AS lines
        FROM documents),
    windows AS (
        SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS win
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM words WHERE len(w) >= 8)),
    twice AS (
        SELECT doc_id, i FROM windows
        QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
    covered AS (
        SELECT doc_id, count(DISTINCT i + k) AS n
        FROM twice, (SELECT unnest(range(0, 8)) AS k) GROUP BY doc_id),
    counted AS (
        SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
               length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
               len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
               coalesce(n, 0) AS n_repeat_words,
               len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS n_stop_words
        FROM words LEFT JOIN covered USING (doc_id)),
    judged AS (
        SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
               concat_ws(',',
                 CASE WHEN n_words = 0 OR word_chars / n_words NOT BETWEEN 2 AND 15
                      THEN 'word_length' END,
                 CASE WHEN n_words > 0 AND n_symbols / n_words > 0.1 THEN 'symbols' END,
                 CASE WHEN n_words = 0 OR n_stop_words / n_words < 0.05 THEN 'stop_words' END,
                 CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.5 THEN 'repeated_lines' END
               ) AS failed_rules
        FROM counted)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND failed_rules = '' AS kept, n_stop_words, failed_rules
    FROM judged"""


def op2() -> str:
    cases = " ".join(f"WHEN '{s}' THEN '[{i}]'" for i, s in licenses.SENTENCES.items())
    steps, last = [], "ids"
    for k, (_, ids) in enumerate(licenses.RULES):
        pattern = licenses.pattern(ids)
        steps.append(
            f"r{k} AS (SELECT * REPLACE (replace(rest, '{pattern}', '[]') AS rest), "
            f"contains(rest, '{pattern}') AS f{k} FROM {last})"
        )
        last = f"r{k}"
    names = list(dict.fromkeys(name for name, _ in licenses.RULES))
    found = {n: [f"f{k}" for k, (m, _) in enumerate(licenses.RULES) if m == n] for n in names}
    # A licence is listed at the first of its rules that matched.
    listed = ", ".join(
        "CASE WHEN "
        + " OR ".join(f)
        + " THEN {'at': CASE "
        + " ".join(f"WHEN {x} THEN {x[1:]}" for x in f)
        + f" END, 'name': '{n}'}} END"
        for n, f in found.items()
    )
    return rf"""
    WITH cut AS (
        SELECT doc_id, list_filter(list_transform(
                 regexp_split_to_array(coalesce(text, ''), '{licenses.BREAK}'),
                 lambda s: trim(lower(regexp_replace(s, '[^A-Za-z0-9]+', ' ', 'g')))),
               lambda s: s <> '') AS sentences
        FROM documents),
    ids AS (
        SELECT doc_id, len(sentences) AS n_sentences,
               array_to_string(list_transform(sentences, lambda s: CASE s {cases} ELSE '' END), '')
                 AS sentence_ids, sentence_ids AS rest
        FROM cut),
    {", ".join(steps)},
    named AS (
        SELECT doc_id, n_sentences, sentence_ids,
               list_sort(list_filter([{listed}], lambda x: x IS NOT NULL)) AS found
        FROM {last})
    SELECT doc_id, n_sentences, sentence_ids,
           array_to_string(list_transform(found, lambda x: x.name), ',') AS licenses,
           len(found) AS n_licenses
    FROM named"""


def op4() -> str:
    said = "\\### Assistant: </turn> ok"
    mask = chat_format.LOSS_ROLE
    return rf"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations
        UNION ALL SELECT -7, 0, 'user', '{said}'
        UNION ALL SELECT -7, 1, 'assistant', '{said}'),
    marked AS (
        SELECT *, row_number() OVER o AS place,
               role IS DISTINCT FROM lag(role) OVER o AS opens
        FROM rows WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
    measured AS (
        SELECT *, length(text) + length(regexp_replace(text, '[^\\<]', '', 'g'))
                  + CASE WHEN opens THEN length('<role:>') + length(role)
                           + length(regexp_replace(role, '[^\\<>]', '', 'g'))
                           + length('<end>') + 1
                         ELSE length('<and>') END AS chars
        FROM marked)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
           sum(CASE WHEN role = '{mask}' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(CASE WHEN role = '{mask}' THEN text END, '' ORDER BY place), ''))
             AS loss_sha256,
           sum(chars)::BIGINT AS formatted_chars
    FROM measured GROUP BY conv_id"""


def op5() -> str:
    weights = ", ".join(f"('{k}', {float(w)})" for k, w in MIX_WEIGHTS.items())
    return rf"""
    WITH RECURSIVE weights AS (
        SELECT * FROM (VALUES {weights}, ('other', {float(MIX_OTHER)})) AS v(key, w)),
    keyed AS (
        SELECT *, CASE WHEN source IN ({sql_list(MIX_WEIGHTS)}) THEN source ELSE 'other' END AS key
        FROM documents),
    sized AS (
        SELECT key, w, count(*) AS n FROM keyed JOIN weights USING (key) GROUP BY ALL),
    rates AS (
        SELECT key, w / (SELECT sum(w) FROM sized) * (SELECT count(*) FROM documents) / n
                 AS mean_copies FROM sized),
    parts AS (
        SELECT key, mean_copies, greatest(ceil(mean_copies / {mixing.LARGEST_MEAN}), 1) AS parts
        FROM rates),
    cdf AS (
        SELECT key, 0 AS k, mean_copies / parts AS mean, exp(-mean_copies / parts) AS p,
               exp(-mean_copies / parts) AS total FROM parts
        UNION ALL
        SELECT key, k + 1, mean, p * mean / (k + 1), total + p * mean / (k + 1)
        FROM cdf WHERE k < {mixing.LAST_COUNT}),
    steps AS (SELECT key, list(total ORDER BY k) AS cdf FROM cdf GROUP BY key),
    drawn AS (
        SELECT d.*, mean_copies,
               list_sum(list_transform(range(0, parts::BIGINT), lambda j: len(list_filter(cdf, lambda c: c <=
                 ('0x' || substr(md5('{MIX_SEED}:' || doc_id || ':' || j), 1, 13))::BIGINT
                 / pow(2.0, 52)))))::BIGINT AS copies
        FROM keyed d JOIN parts USING (key) JOIN steps USING (key)),
    copied AS (SELECT *, unnest(range(0, copies)) AS copy_no FROM drawn WHERE copies > 0)
    SELECT doc_id, text, lang, source, n_chars, copy_no, mean_copies,
           md5('order{MIX_SEED}:' || doc_id || ':' || copy_no) AS shuffle_key
    FROM copied"""


def op8() -> str:
    return """
    WITH RECURSIVE vectors AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS MATERIALIZED (
        SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
        WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
    reached AS (
        SELECT vec_id AS x, vec_id AS root FROM vectors
        UNION SELECT l.y, r.root FROM reached r JOIN links l ON l.x = r.x WHERE r.root < l.y),
    smallest AS (SELECT x, min(root) AS root FROM reached GROUP BY x),
    degrees AS (SELECT x, count(*) AS n FROM links GROUP BY x)
    SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id,
           vec_id = coalesce(root, vec_id) AS kept
    FROM embeddings LEFT JOIN degrees d ON d.x = vec_id LEFT JOIN smallest s ON s.x = vec_id"""


def op10() -> str:
    return r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    shingles AS MATERIALIZED (
        SELECT DISTINCT doc_id, hash(s) AS s FROM (
            SELECT doc_id, unnest(list_transform(
                     range(1, greatest(len(w) - 4, 1) + 1),
                     lambda i: array_to_string(w[i:i + 4], ' '))) AS s
            FROM words WHERE len(w) > 0)),
    sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS MATERIALIZED (
        SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
        WHERE 100 * n_both >= 80 * (p.n + q.n - n_both)),
    both_ways AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reached AS (
        SELECT doc_id AS x, doc_id AS root FROM sizes
        UNION SELECT b.y, r.root FROM reached r JOIN both_ways b ON b.x = r.x WHERE r.root < b.y),
    smallest AS (SELECT x, min(root) AS root FROM reached GROUP BY x)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(root, d.doc_id) AS component_id
    FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN smallest ON x = d.doc_id"""


def op12() -> str:
    return """
    WITH hashed AS (
        SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS h FROM documents),
    drawn AS (
        SELECT doc_id, t, length(t) AS n, ('0x' || h[1:8])::UBIGINT AS h1,
               ('0x' || h[9:16])::UBIGINT AS h2, ('0x' || h[17:24])::UBIGINT AS h3,
               ('0x' || h[25:32])::UBIGINT AS h4
        FROM hashed),
    formed AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a,
               greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS b,
               CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                         OR h3 % 100 >= 90 THEN 'plain'
                    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM drawn),
    cut AS (
        SELECT *, '<P>' || substring(t, 1, a) AS p, '<M>' || substring(t, a + 1, b - a) AS m,
               '<S>' || substring(t, b + 1, n - b) AS s
        FROM formed)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN s || p || m
                            ELSE p || s || m END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM cut"""


def op13() -> str:
    distance = (
        "list_sum(list_transform(range(1, len(x) + 1), "
        "lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT"
    )
    rounds = "".join(
        f"""
    near{k} AS MATERIALIZED (
        SELECT vec_id, p, any_value(x) AS x, min({distance} * 64 + e) AS best
        FROM parts JOIN book{k} USING (p) GROUP BY vec_id, p),
    sums{k} AS (
        SELECT p, best % 64 AS e, i, sum(x[i]) AS total, count(*) AS many
        FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS i FROM near{k}) GROUP BY ALL),
    means{k} AS (
        SELECT p, e, list(floor(total / many)::BIGINT ORDER BY i) AS m FROM sums{k} GROUP BY p, e),
    book{k + 1} AS MATERIALIZED (
        SELECT p, e, coalesce(m, c) AS c FROM book{k} LEFT JOIN means{k} USING (p, e)),"""
        for k in range(2)
    )
    return f"""
    WITH kept AS (
        SELECT vec_id, label,
               list_transform(embedding, lambda y: floor(256 * y::DOUBLE)::BIGINT) AS v
        FROM embeddings WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
    parts AS MATERIALIZED (
        SELECT vec_id, p, v[p * len(v) // 16 + 1:(p + 1) * len(v) // 16] AS x
        FROM kept, (SELECT unnest(range(16)) AS p)),
    book0 AS MATERIALIZED (
        SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts
        WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)),
    {rounds}
    last AS (
        SELECT vec_id, p, min({distance} * 64 + e) AS best
        FROM parts JOIN book2 USING (p) GROUP BY vec_id, p),
    codes AS MATERIALIZED (
        SELECT vec_id, string_agg(lower(printf('%02x', (best % 64)::INTEGER)), '' ORDER BY p) AS code,
               sum(best // 64)::BIGINT AS error
        FROM last GROUP BY vec_id),
    labels_of AS (
        SELECT vec_id, code, error, label FROM codes JOIN kept USING (vec_id)),
    books AS (
        SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS s FROM book2)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           s AS codebooks_sha256
    FROM labels_of, books"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": op1(),
        "op2_license_scan": op2(),
        "op4_chat_format": op4(),
        "op5_source_mixing": op5(),
        "op8_embedding_links": op8(),
        "op10_ngram_join": op10(),
        "op12_fill_in_middle": op12(),
        "op13_vector_codes": op13(),
    }
