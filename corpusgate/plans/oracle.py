"""The queries as SQL for another engine, written independently of the column builders."""

from __future__ import annotations

# Fixed values, written out here again so that the SQL checks them too.
LABELS = ["Điều", "Dieu", "Äiá»u", "ÄIá»€U", "Ðiá»u", "ĐIỀU"]
CLAIMS = ["this is official legal text", "this is official legal advice", "official legal authority", "official legal answer", "binding legal advice", "authoritative legal interpretation"]
TASK_TYPES = ["classification", "explanation", "retrieval_style_qa", "drafting_demo"]
DIFFICULTIES = ["easy", "medium", "hard"]
DOCUMENT_TYPES = ["hien_phap", "bo_luat", "luat", "nghi_dinh", "thong_tu", "quyet_dinh", "nghi_quyet", "other"]
STATUSES = ["in_force", "expired", "amended", "unknown"]
DEMO_DIMENSIONS = {"topic": (["permit renewal", "address change", "invoice check"], 5), "actor": (["shop owner", "branch clerk"], 7), "place": (["north office", "south office", "harbour desk", "market hall"], 11)}
DEMO_TEMPLATES = {
    "instruction": ["Explain the next step of {topic} for case {case_anchor}.", "Draft a synthetic note on {topic} for the {place}."],
    "input": ["Scenario {index}: a {actor} at the {place} asks about {topic}."],
    "output": ["Demo answer for {case_anchor}: check the {topic} with the {actor} first.", "Synthetic reply: the {place} files the {topic}.", "Demo note: a {actor} keeps the {topic}."],
}
TASK_NOTES = {"explanation": "may leave out conditions", "drafting_demo": "may overstate effect"}
POLICY_PHRASES = ["thời hạn", "complaint box", "not legal advice"]
ALL_PHRASES = ["thời hạn", "hồ sơ"]

# White space in the Unicode sense for RE2.
_WS = r"[\t-\r\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_MARKER = r"(?m)^(\s{0,3}(?:#{1,6}\s*)?)(?:" + "|".join(LABELS) + r")\s+(\d+)[ \t]*(?:[.:]|-)?[ \t]*([^\n]*)$"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _trim(c: str) -> str:
    return f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"


def _tidy(c: str) -> str:
    return f"coalesce({_trim(c)}, '')"


def _blank(c: str) -> str:
    return f"({_tidy(c)} = '')"


def _listed(values: list[str]) -> str:
    return "(" + ", ".join(map(_q, values)) + ")"


_NORMALIZED = f"""
    WITH named AS (
        SELECT *, {_tidy("coalesce(nullif(text, ''))")} AS t, {_tidy("coalesce(nullif(source_id, ''), nullif(doc_id, ''))")} AS sid,
               lower({_trim("doc_type")}) AS dt, lower({_trim("status")}) AS st
        FROM synthetic_legal_articles
    ), normalized AS (
        SELECT substr(sha256(coalesce(source_dataset, '') || '|' || CASE WHEN sid = '' THEN 'UNKNOWN' ELSE sid END || '|' || substr(t, 1, 200)), 1, 16) AS record_id,
               source_dataset, source_url, CASE WHEN sid = '' THEN 'UNKNOWN' ELSE sid END AS source_id, license, retrieved_at,
               CASE WHEN dt IN ('hien_phap', 'bo_luat', 'luat', 'nghi_dinh', 'thong_tu', 'quyet_dinh', 'nghi_quyet', 'other') THEN dt ELSE 'other' END AS document_type,
               {_tidy("number")} AS document_number, {_tidy("coalesce(nullif(title, ''), nullif(document_title, ''))")} AS title, nullif(article_number, 0) AS article_number,
               CAST(NULL AS VARCHAR) AS clause_number, nullif(t, '') AS text,
               CASE WHEN st IN ('in_force', 'expired', 'amended', 'unknown') THEN st ELSE 'unknown' END AS effective_status,
               CASE WHEN t = '' THEN 'Record has no usable text field.' END AS error
        FROM named
    )
"""

_QUALITY = f"""
    {_NORMALIZED}, q AS (
        SELECT count(*) AS total_seen, count(*) FILTER (WHERE error IS NULL) AS total_normalized, count(*) FILTER (WHERE error IS NOT NULL) AS total_rejected,
               count(DISTINCT record_id) FILTER (WHERE error IS NULL) AS ids,
               count(*) FILTER (WHERE error IS NULL AND ({_blank("source_dataset")} OR {_blank("source_url")} OR {_blank("license")} OR {_blank("retrieved_at")})) AS meta,
               count(*) FILTER (WHERE error IS NULL AND ({_blank("license")} OR upper(license) = 'UNKNOWN')) AS lic,
               count(*) FILTER (WHERE error IS NULL AND article_number < 1) AS bad
        FROM normalized
    ), m AS (
        SELECT total_seen, total_normalized, total_rejected, round_even(total_normalized / total_seen, 6) AS parse_success_rate, 0.0::DOUBLE AS empty_text_rate,
               round_even((total_normalized - ids) / total_normalized, 6) AS duplicate_rate, round_even(meta / total_normalized, 6) AS missing_metadata_rate,
               round_even(lic / total_normalized, 6) AS missing_license_rate, round_even(bad / total_normalized, 6) AS malformed_article_rate
        FROM q
    )
"""

_DOCS = f"""
    WITH d AS (
        SELECT CAST(doc_id AS VARCHAR) AS record_id, {_trim("text")} AS t, text AS raw,
               [x FOR x IN [CASE WHEN {_blank("source")} THEN 'source_dataset' END, CASE WHEN {_blank("license")} THEN 'license' END, CASE WHEN retrieved_at IS NULL THEN 'retrieved_at' END] IF x IS NOT NULL] AS missing
        FROM documents
    ), pieces AS (
        SELECT *, CASE WHEN coalesce(t, '') <> '' THEN string_split(regexp_replace(replace(t, chr(1), ''), {_q(_MARKER)}, chr(1) || '\\0', 'g'), chr(1)) END AS p FROM d
    ), parsed AS (
        SELECT *, CASE WHEN len(missing) > 0 THEN 'missing_required_provenance' WHEN coalesce(t, '') = '' THEN 'blank_document_text' WHEN len(p) < 2 THEN 'no_article_markers_detected' END AS reason FROM pieces
    ), articles AS (
        SELECT record_id, article_pos, TRY_CAST(regexp_extract(piece, {_q(_MARKER)}, 2) AS INTEGER) AS article_number,
               CASE WHEN NOT regexp_full_match({_trim(f"regexp_extract(piece, {_q(_MARKER)}, 3)")}, '[.:-]*') THEN {_trim(f"regexp_extract(piece, {_q(_MARKER)}, 3)")} END AS article_title,
               {_trim("piece")} AS text, starts_with({_trim(f"regexp_extract(piece, {_q(_MARKER)}, 1)")}, '#') AS heading
        FROM (SELECT record_id, unnest(p[2:]) AS piece, generate_subscripts(p[2:], 1) AS article_pos FROM parsed WHERE reason IS NULL)
    ), flagged AS (
        SELECT *, [x FOR x IN [CASE WHEN article_title IS NULL THEN 'article_title_missing' END, CASE WHEN heading THEN 'markdown_heading_marker' END,
                  CASE WHEN length(text) > 50000 THEN 'suspicious_long_article' END, CASE WHEN length(text) < 100 THEN 'suspicious_short_article' END] IF x IS NOT NULL] AS flags
        FROM articles
    )
"""

_ACC = "{{'d': {d}, 'h': {h}}}"


def _held(state: str, part: str, glue: str) -> str:
    return f"CASE WHEN {state}.h = '' THEN {part} ELSE {state}.h || {glue} || {part} END"


def _flushed(state: str) -> str:
    return f"CASE WHEN {state}.h = '' THEN {state}.d ELSE list_append({state}.d, {state}.h) END"


def _parts(text: str, cut: str) -> str:
    return f"[x FOR x IN [{_trim('y')} FOR y IN string_split_regex({text}, '{cut}')] IF x <> '']"


def _chunks(text: str, most: int) -> str:
    """Paragraphs, and lines of long ones, packed greedily, as nested folds."""
    none = "CAST([] AS VARCHAR[])"
    elements = lambda parts: f"list_transform({parts}, lambda e: {_ACC.format(d=none, h='e')})"
    line = f"CASE WHEN length({_held('b', 'l.h', 'chr(10)')}) <= {most} THEN {_ACC.format(d='b.d', h=_held('b', 'l.h', 'chr(10)'))} ELSE {_ACC.format(d=_flushed('b'), h='l.h')} END"
    lines = f"list_reduce({elements(_parts('q.h', _LINE_END))}, lambda b, l: {line}, {_ACC.format(d=_flushed('a'), h=chr(39) * 2)})"
    both = _held("a", "q.h", "chr(10) || chr(10)")
    paragraph = f"CASE WHEN length({both}) <= {most} THEN {_ACC.format(d='a.d', h=both)} WHEN length(q.h) <= {most} THEN {_ACC.format(d=_flushed('a'), h='q.h')} ELSE {lines} END"
    paragraphs = _parts(text, "\\n" + _WS + "*\\n")
    packed = f"list_reduce({elements(paragraphs)}, lambda a, q: {paragraph}, {_ACC.format(d=none, h=chr(39) * 2)})"
    return f"CASE WHEN length({text}) <= {most} THEN [{text}] ELSE (SELECT {_flushed('z')} FROM (SELECT {packed} AS z)) END"


_LINE_END = r"\r\n|[\n\v\f\r\x{85}\x{2028}\x{2029}]"


def _chunked(most: int) -> str:
    return f"""
        {_DOCS}, chunked AS (SELECT *, {_chunks("text", most)} AS chunks FROM flagged), rows AS (
            SELECT record_id, article_pos, article_number, unnest(chunks) AS chunk, CAST(generate_subscripts(chunks, 1) - 1 AS INTEGER) AS chunk_index,
                   list_sort(CASE WHEN len(chunks) > 1 THEN list_append(flags, 'split_into_multiple_chunks') ELSE flags END) AS own FROM chunked)
    """


_HASHED = f"""
    WITH h AS (
        SELECT *, CASE WHEN NOT {_blank("text_hash")} THEN text_hash WHEN NOT {_blank("text")} THEN substr(sha256({_trim("text")}), 1, 16) ELSE '' END AS article_hash FROM article_candidates
    ), g AS (
        SELECT article_hash, min(input_index) AS canonical_index, arg_min(candidate_id, input_index) AS canonical_id, count(*) AS group_size FROM h WHERE NOT {_blank("article_hash")} GROUP BY article_hash
    )
"""

_DECIDED = f"""
    {_HASHED}, c AS (
        SELECT h.*, canonical_index, canonical_id, coalesce(group_size, 0) AS group_size, length({_tidy("text")}) AS chars,
               CASE WHEN {_blank("text")} THEN 0 ELSE len(regexp_split_to_array({_trim("text")}, '{_WS}+')) END AS words
        FROM h LEFT JOIN g USING (article_hash)
    ), r AS (
        SELECT *, [x FOR x IN [
            CASE WHEN {" OR ".join(_blank(f) for f in ("parent_record_id", "source_dataset", "source_id", "source_url", "license", "retrieved_at"))} THEN 'reject_missing_parent_provenance' END,
            CASE WHEN {_blank("text")} THEN 'reject_empty' END, CASE WHEN {_blank("article_hash")} THEN 'reject_missing_required_hash' END,
            CASE WHEN canonical_index <> input_index THEN 'reject_duplicate_hash' END, CASE WHEN NOT {_blank("text")} AND (chars < 80 OR words < 12) THEN 'reject_near_empty' END,
            CASE WHEN NOT {_blank("text")} AND (chars < 100 OR chars > 50000) THEN 'needs_review_suspicious_length' END,
            CASE WHEN list_contains(parse_flags, 'markdown_heading_marker') OR starts_with({_tidy("text")}, '#') THEN 'needs_review_preamble_or_header_noise' END,
            CASE WHEN uncertain_parse OR list_contains(parse_flags, 'article_title_missing') OR list_contains(parse_flags, 'article_number_unparsed') THEN 'needs_review_marker_uncertainty' END
        ] IF x IS NOT NULL] AS why FROM c
    ), decided AS (
        SELECT *, coalesce([x FOR x IN why IF starts_with(x, 'reject_')][1], why[1], 'keep_candidate_for_human_review') AS filter_decision,
               CASE WHEN canonical_index <> input_index THEN canonical_id END AS duplicate_of FROM r
    )
"""

_RANK = "sha256('42|{salt}|' || input_index || '|' || candidate_id || '|' || coalesce(parent_record_id, '') || '|' || article_hash)"

def _sample() -> str:
    """The five buckets one after the other, each without the rows drawn before."""
    targets = {"duplicate_related": 10, "suspicious_length": 10, "keep_candidate_for_human_review": 60, "needs_review": 50, "rejected": 20}
    pools = {
        "duplicate_related": f"(SELECT * FROM decided WHERE group_size > 1 QUALIFY row_number() OVER (PARTITION BY article_hash ORDER BY CASE WHEN filter_decision = 'reject_duplicate_hash' THEN 0 ELSE 1 END, {_RANK.format(salt='duplicate_related_group')}, CAST(input_index AS VARCHAR)) = 1)",
        "suspicious_length": "(SELECT * FROM decided WHERE list_contains(why, 'needs_review_suspicious_length'))", "keep_candidate_for_human_review": "(SELECT * FROM decided WHERE filter_decision = 'keep_candidate_for_human_review')",
        "needs_review": "(SELECT * FROM decided WHERE starts_with(filter_decision, 'needs_review_'))", "rejected": "(SELECT * FROM decided WHERE starts_with(filter_decision, 'reject_'))",
    }
    parts, before = [], []
    for b, n in targets.items():
        drawn = "".join(f" AND input_index NOT IN (SELECT input_index FROM pick_{x})" for x in before)
        parts.append(f"""pick_{b} AS (
            SELECT *, row_number() OVER (ORDER BY turn, sha256('42|{b}:parent|' || parent), parent) AS sample_index, '{b}' AS sampling_bucket FROM (
                SELECT *, coalesce(parent_record_id, '') AS parent, row_number() OVER (PARTITION BY coalesce(parent_record_id, '') ORDER BY {_RANK.format(salt=b)}, CAST(input_index AS VARCHAR)) AS turn FROM {pools[b]} WHERE true{drawn})
            QUALIFY sample_index <= {n})""")
        before.append(b)
    columns = "input_index, candidate_id, sampling_bucket, sample_index, chars"
    return f"{_DECIDED}, {', '.join(parts)}, sample AS ({' UNION ALL '.join(f'SELECT {columns} FROM pick_{b}' for b in targets)})"


_REVIEW_FIELDS = ["reviewer_id", "review_date", "candidate_id", "decision_label", "confidence", "notes", "legal_ground_truth_approved", "rag_index_approved"]
_LABELS = "('accept_for_later_corpus_candidate', 'reject_not_article', 'reject_duplicate', 'reject_too_short', 'reject_too_long', 'reject_missing_metadata', 'needs_legal_expert_review', 'needs_parser_fix', 'uncertain')"
_REVIEWS = f"""
    WITH t AS (
        SELECT review_row, review_sample_id, {", ".join(f"{_tidy(f)} AS {f}" for f in _REVIEW_FIELDS if f not in ("decision_label", "confidence"))},
               lower({_tidy("decision_label")}) AS decision_label, lower({_tidy("confidence")}) AS confidence FROM reviewer_decisions_completed
    ), v AS (
        SELECT *, list_sort(list_distinct([x FOR x IN [{", ".join(f"CASE WHEN {f} = '' THEN '{f} is required.' END" for f in _REVIEW_FIELDS)},
            CASE WHEN review_date <> '' AND NOT coalesce(regexp_full_match(review_date, '\\d{{4}}-\\d{{2}}-\\d{{2}}') AND TRY_CAST(review_date AS DATE) IS NOT NULL, false) THEN 'review_date must be ISO format YYYY-MM-DD.' END,
            {", ".join(f"CASE WHEN lower({f}) IN ('true', '1', 'yes', 'y') THEN '{f} must remain false.' WHEN {f} <> '' AND lower({f}) NOT IN ('false', '0', 'no', 'n') THEN '{f} must be a boolean false value.' END" for f in ("legal_ground_truth_approved", "rag_index_approved"))},
            CASE WHEN decision_label <> '' AND decision_label NOT IN {_LABELS} THEN 'decision_label is invalid: ' || decision_label END,
            CASE WHEN confidence <> '' AND confidence NOT IN ('high', 'medium', 'low') THEN 'confidence is invalid: ' || confidence END
        ] IF x IS NOT NULL])) AS reasons FROM t
    ), a AS (
        SELECT candidate_id, count(*) AS review_count, list_sort(list(DISTINCT reviewer_id)) AS reviewer_ids, list_sort(list(DISTINCT decision_label)) AS decision_labels, list_sort(list(DISTINCT confidence)) AS confidence_values
        FROM v WHERE len(reasons) = 0 GROUP BY candidate_id
    ), adjudicated AS (
        SELECT *, CASE WHEN list_contains(decision_labels, 'needs_parser_fix') THEN 'parser_fix_required' WHEN list_contains(decision_labels, 'needs_legal_expert_review') THEN 'legal_expert_review_required'
                       WHEN list_contains(decision_labels, 'uncertain') THEN 'uncertain_requires_adjudication' WHEN len(decision_labels) = 1 THEN 'consensus' ELSE 'label_conflict_requires_adjudication' END AS adjudication_status,
               CASE WHEN len(decision_labels) = 1 THEN decision_labels[1] END AS consensus_label FROM a
    ), settled AS (
        SELECT *, CASE WHEN adjudication_status = 'consensus' AND consensus_label = 'accept_for_later_corpus_candidate' THEN 'accepted'
                       WHEN adjudication_status = 'consensus' AND starts_with(consensus_label, 'reject_') THEN 'rejected' ELSE 'unresolved' END AS outcome FROM adjudicated
    )
"""


_ONE_RAW = "SELECT {fields} FROM reviewer_decisions_completed WHERE NOT {blank} QUALIFY row_number() OVER (PARTITION BY {id} ORDER BY {order}) = 1"


def _one(fields: str, order: list[str], tie: str = "") -> str:
    return _ONE_RAW.format(fields=f"{_tidy('candidate_id')} AS id, {fields}", blank=_blank("candidate_id"), id=_tidy("candidate_id"), order=", ".join([*map(_tidy, order), *([tie] if tie else [])]))


def _either(field: str) -> str:
    return _tidy(f"coalesce(nullif(sm.{field}, ''), nullif(fl.{field}, ''))")


_MANIFEST = f"""
    {_REVIEWS}, {_DECIDED.strip().removeprefix("WITH ").replace(", c AS (", ", cand AS (").replace("FROM c\n", "FROM cand\n")}, rv AS ({_one("decision_label, reviewer_id, review_date, confidence, notes, legal_ground_truth_approved AS lg, rag_index_approved AS rg", ["review_date", "reviewer_id", "decision_label", "confidence", "review_sample_id"], "review_row")}),
    sm AS ({_one("parent_record_id, source_dataset, source_id, source_url, title, article_number, article_title, sampling_bucket, license, review_sample_id, filter_decision", ["parent_record_id", "source_id", "review_sample_id", "filter_decision"])}),
    joined AS (
        SELECT acc.candidate_id, {_either("parent_record_id")} AS parent_record_id, {_either("license")} AS license, {_tidy("coalesce(nullif(fl.text_hash, ''), fl.article_hash)")} AS text_hash, {_tidy("rv.reviewer_id")} AS reviewer_id,
               {_tidy("rv.review_date")} AS review_date, {_tidy("sm.review_sample_id")} AS review_sample_id, {_tidy("coalesce(nullif(fl.filter_decision, ''), sm.filter_decision)")} AS filter_decision, acc.review_count AS accepted_review_count,
               {_either("source_dataset")} AS source_dataset, {_either("source_id")} AS source_id, {_either("source_url")} AS source_url, {_either("title")} AS title, {_either("article_title")} AS article_title, {_tidy("fl.parser_version")} AS parser_version,
               CASE WHEN fl.candidate_id IS NULL THEN '' ELSE 'corpusgate_filter_v1' END AS filter_version, coalesce(sm.article_number, CAST(fl.article_number AS VARCHAR)) AS article_number, {_tidy("rv.decision_label")} AS decision_label,
               {_tidy("rv.confidence")} AS confidence, {_tidy("rv.notes")} AS review_notes, {_tidy("sm.sampling_bucket")} AS sampling_bucket, 'accepted' AS accepted_audit_bucket, acc.consensus_label AS accepted_consensus_label,
               CASE WHEN rv.id IS NULL THEN ['missing_completed_review_row'] ELSE [x FOR x IN [CASE WHEN {_tidy("rv.decision_label")} <> 'accept_for_later_corpus_candidate' THEN 'review_decision_not_accept_for_later_corpus_candidate' END,
                   CASE WHEN lower({_tidy("lg")}) IN ('true', '1', 'yes', 'y') THEN 'review_row_legal_ground_truth_approved_true' END, CASE WHEN lower({_tidy("rg")}) IN ('true', '1', 'yes', 'y') THEN 'review_row_rag_index_approved_true' END] IF x IS NOT NULL] END AS problems,
               [x FOR x IN [CASE WHEN {_either("parent_record_id")} = '' THEN 'parent_record_id' END, CASE WHEN {_either("source_dataset")} = '' THEN 'source_dataset' END, CASE WHEN {_either("license")} = '' THEN 'license' END,
                   CASE WHEN {_blank("fl.parser_version")} THEN 'parser_version' END, CASE WHEN fl.candidate_id IS NULL THEN 'filter_version' END] IF x IS NOT NULL] AS missing_fields
        FROM (SELECT * FROM settled WHERE outcome = 'accepted') acc LEFT JOIN rv ON rv.id = acc.candidate_id LEFT JOIN sm ON sm.id = acc.candidate_id LEFT JOIN decided fl ON fl.candidate_id = acc.candidate_id
    )
"""

_RISK = f"""
    {_DECIDED}, flags AS (
        SELECT unnest([{", ".join(f"CASE WHEN {_blank(f)} THEN 'missing_{f}' END" for f in ("parent_record_id", "source_dataset", "source_id", "source_url", "license", "retrieved_at"))},
            {", ".join(f"CASE WHEN list_contains(why, '{r}') THEN '{flag}' END" for r, flag in (("reject_empty", "empty_text"), ("reject_missing_required_hash", "missing_article_hash"), ("reject_duplicate_hash", "duplicate_hash_loser"), ("reject_near_empty", "near_empty_text"), ("needs_review_suspicious_length", "suspicious_length_text"), ("needs_review_preamble_or_header_noise", "candidate_header_noise"), ("needs_review_marker_uncertainty", "marker_uncertainty")))}]) AS risk_flag FROM decided
    )
"""


def _fill(column: str) -> str:
    texts = DEMO_TEMPLATES[column]
    out = f"[{', '.join(map(_q, texts))}][((i - 1) % {len(texts)} + 1)::INTEGER]"
    for d, (values, stride) in DEMO_DIMENSIONS.items():
        out = f"replace({out}, '{{{d}}}', [{', '.join(map(_q, values))}][(((i - 1) * {stride}) % {len(values)} + 1)::INTEGER])"
    return f"replace(replace({out}, '{{case_anchor}}', printf('synthetic-demo-%06d', i)), '{{index}}', CAST(i AS VARCHAR))"


def _first_text_error() -> str:
    parts = []
    for f in ["id", "instruction", "input", "output", "source", "format", "domain", "task_type", "difficulty", "disclaimer"]:
        parts.append(f"WHEN {f} IS NULL THEN '{f} must be a string.'")
        if f != "input":
            parts.append(f"WHEN {_blank(f)} THEN '{f} must not be blank.'")
    return "CASE " + " ".join(parts) + " END"


_CLAIM = " OR ".join(f"contains(lower(concat_ws(' ', {_tidy('instruction')}, {_tidy('input')}, {_tidy('output')})), {_q(c)})" for c in CLAIMS)
_VALID = f"""list_concat([x FOR x IN [
    CASE WHEN NOT starts_with({_tidy("id")}, 'mock-qa-') THEN 'id must start with mock-qa-.' END, CASE WHEN {_tidy("source")} <> 'template-drill' THEN 'source must equal template-drill.' END,
    CASE WHEN {_tidy("format")} <> 'alpaca' THEN 'format must equal alpaca.' END, CASE WHEN {_tidy("domain")} <> 'vietnamese-legal-demo' THEN 'domain must equal vietnamese-legal-demo.' END,
    CASE WHEN {_tidy("task_type")} NOT IN {_listed(TASK_TYPES)} THEN 'task_type is invalid: ' || {_tidy("task_type")} END, CASE WHEN {_tidy("difficulty")} NOT IN {_listed(DIFFICULTIES)} THEN 'difficulty is invalid: ' || {_tidy("difficulty")} END,
    CASE WHEN is_synthetic IS DISTINCT FROM true THEN 'is_synthetic must be true.' END, CASE WHEN is_legal_ground_truth IS DISTINCT FROM false THEN 'is_legal_ground_truth must be false.' END,
    CASE WHEN approved_for_rag_index IS DISTINCT FROM false THEN 'approved_for_rag_index must be false.' END,
    CASE WHEN NOT contains(lower({_tidy("disclaimer")}), 'synthetic') THEN 'disclaimer must mention: synthetic' END, CASE WHEN NOT contains(lower({_tidy("disclaimer")}), 'demo') THEN 'disclaimer must mention: demo' END,
    CASE WHEN NOT contains(lower({_tidy("disclaimer")}), 'not legal advice') THEN 'disclaimer must mention: not legal advice' END, CASE WHEN {_CLAIM} THEN 'Row must not claim official legal authority.' END
] IF x IS NOT NULL], [])"""

_NL = "chr(10)"
_HEAD = f"concat('### Disclaimer', {_NL}, coalesce(disclaimer, ''), {_NL}, {_NL}, '### Instruction', {_NL}, {_tidy('instruction')}, {_NL}, {_NL}, CASE WHEN {_blank('input')} THEN '' ELSE concat('### Context', {_NL}, {_tidy('input')}, {_NL}, {_NL}) END, '### Response', {_NL})"
_SPLIT = """
    WITH n AS (SELECT row_no, row_number() OVER (ORDER BY sha256('42|' || row_no)) AS i, count(*) OVER () AS n FROM sample_qa)
    , s AS (SELECT row_no, CASE WHEN i <= floor(n * 0.8) THEN 'train' WHEN i <= floor(n * 0.8) + floor(n * 0.1) THEN 'validation' ELSE 'test' END AS split_name FROM n)
"""
_AUDIT_MARKS = r"len(regexp_extract_all(coalesce(text, ''), '(?i)(?:^|\n)" + _WS.replace("'", "''") + r"*(?:dieu|điều)" + _WS + r"+\d+'))"
_NOT_WORD = r"[^\p{L}\p{N}_\p{M}]"


def _cites(c: str) -> str:
    t = f"coalesce({c}, '')"
    pats = [
        rf"(?i)(?:^|{_NOT_WORD})(?:dieu|diều|điều){_WS}+\d", rf"(?i)(?:^|{_NOT_WORD})(?:khoan|khoản){_WS}+\d",
        rf"(?i)(?:^|{_NOT_WORD})(?:luat|luật|bo luat|bộ luật|nghi dinh|nghị định|thong tu|thông tư|quyet dinh|quyết định)(?:{_NOT_WORD}|$)", rf"(?:^|{_NOT_WORD})\d+/\d{{4}}/[A-ZĐ\-]",
    ]
    return "(" + " OR ".join(f"regexp_matches({t}, {_q(p)})" for p in pats) + ")"


ORACLE_SQL: dict[str, str] = {
    "q_filter_decisions": f"{_DECIDED} SELECT input_index, candidate_id, filter_decision, CASE WHEN len(why) = 0 THEN 'keep_candidate_for_human_review' ELSE array_to_string(list_sort(why), ',') END AS filter_reasons, duplicate_of, chars AS text_char_count, words AS text_word_count FROM decided",
    "q_filter_buckets": f"{_DECIDED} SELECT CASE WHEN starts_with(filter_decision, 'reject_') THEN 'rejected' WHEN starts_with(filter_decision, 'needs_review_') THEN 'needs_review' ELSE 'keep' END AS bucket, count(*) AS count FROM decided GROUP BY 1",
    "q_filter_metrics": f"""
        {_DECIDED} SELECT *, total_rejected + total_needs_review + total_keep = total_input_candidates AS counts_reconcile FROM (
            SELECT count(*) AS total_input_candidates, count(*) FILTER (WHERE starts_with(filter_decision, 'reject_')) AS total_rejected, count(*) FILTER (WHERE starts_with(filter_decision, 'needs_review_')) AS total_needs_review,
                   count(*) FILTER (WHERE filter_decision = 'keep_candidate_for_human_review') AS total_keep, count(*) FILTER (WHERE canonical_index <> input_index) AS duplicate_candidates_rejected,
                   count(*) FILTER (WHERE filter_decision = 'reject_missing_parent_provenance') AS missing_required_fields_count, count(*) FILTER (WHERE chars = 0) AS empty_count, CAST(0 AS BIGINT) AS with_parent_warning,
                   count(*) FILTER (WHERE list_contains(why, 'reject_near_empty')) AS near_empty_count, count(*) FILTER (WHERE chars < 100 OR chars > 50000) AS suspicious_length_count,
                   count(*) FILTER (WHERE list_contains(why, 'needs_review_preamble_or_header_noise')) AS preamble_warning_count, count(*) FILTER (WHERE list_contains(why, 'needs_review_marker_uncertainty')) AS marker_uncertainty_count,
                   round_even(count(*) FILTER (WHERE NOT list_contains(why, 'reject_missing_parent_provenance')) / count(*), 6) AS parent_provenance_coverage, count(*) AS total_output_records,
                   count(*) FILTER (WHERE group_size > 1 AND canonical_index = input_index) AS duplicate_hash_groups, CAST(0 AS BIGINT) AS approved_for_rag_index_true_count, CAST(0 AS BIGINT) AS is_legal_ground_truth_true_count FROM decided)
    """,
    "q_filter_reasons": f"{_DECIDED} SELECT CASE WHEN starts_with(filter_decision, 'reject_') THEN 'rejected' WHEN starts_with(filter_decision, 'needs_review_') THEN 'needs_review' ELSE 'keep' END AS bucket, filter_decision, count(*) AS candidates FROM decided GROUP BY 1, 2",
    "q_union_outputs": f"""
        {_DECIDED} SELECT filter_decision, count(*) AS candidates, count(*) FILTER (WHERE starts_with(filter_decision, 'reject_') AND canonical_index <> input_index) AS with_original,
            count(*) FILTER (WHERE starts_with(filter_decision, 'needs_review_')) AS with_reasons FROM decided GROUP BY 1
    """,
    "q_candidate_ids": f"{_HASHED} SELECT input_index, substr(sha256(coalesce(parent_record_id, '') || '|' || coalesce(source_id, '') || '|' || coalesce(CAST(nullif(article_number, 0) AS VARCHAR), '') || '|' || coalesce(CAST(nullif(chunk_index, 0) AS VARCHAR), '') || '|' || article_hash), 1, 16) AS made_id, article_hash FROM h",
    "q_duplicate_groups": f"{_HASHED} SELECT article_hash, group_size FROM g WHERE group_size > 1",
    "q_canonical_duplicates": f"{_HASHED} SELECT input_index, canonical_index, canonical_id, group_size FROM h JOIN g USING (article_hash) WHERE canonical_index <> input_index",
    "q_parent_warnings": f"{_DOCS} SELECT record_id AS parent_record_id, CASE WHEN reason IS NULL AND {_tidy('p[1]')} <> '' THEN 'preamble_before_first_article' ELSE '' END AS codes FROM parsed",
    "q_normalize_records": f"{_NORMALIZED} SELECT * EXCLUDE (error) FROM normalized WHERE error IS NULL",
    "q_rejected_records": f"{_NORMALIZED} SELECT source_id, title, error FROM normalized WHERE error IS NOT NULL",
    "q_quality_metrics": f"{_QUALITY} SELECT * FROM m",
    "q_quality_violations": f"""
        {_QUALITY} SELECT metric, value, bound FROM (SELECT unnest([
            {{'metric': 'parse_success_rate', 'value': parse_success_rate, 'bound': 0.99::DOUBLE, 'low': true}}, {{'metric': 'empty_text_rate', 'value': empty_text_rate, 'bound': 0.005::DOUBLE, 'low': false}},
            {{'metric': 'duplicate_rate', 'value': duplicate_rate, 'bound': 0.02::DOUBLE, 'low': false}}, {{'metric': 'missing_metadata_rate', 'value': missing_metadata_rate, 'bound': 0.01::DOUBLE, 'low': false}},
            {{'metric': 'missing_license_rate', 'value': missing_license_rate, 'bound': 0.01::DOUBLE, 'low': false}}, {{'metric': 'malformed_article_rate', 'value': malformed_article_rate, 'bound': 0.01::DOUBLE, 'low': false}}
        ], recursive := true) FROM m) WHERE CASE WHEN low THEN value < bound ELSE value > bound END
    """,
    "q_source_lookup": "SELECT source, records, m.license AS manifest_license, license_confirmed, attribution_required FROM (SELECT source, count(*) AS records FROM documents GROUP BY source) LEFT JOIN source_manifest m ON source = source_dataset",
    "q_content_summary": f"""
        SELECT count(*) AS records, CAST(sum(n) AS BIGINT) AS total_chars, count(*) FILTER (WHERE n = 0) AS empty, count(*) FILTER (WHERE n <= 50) AS near_empty, count(*) FILTER (WHERE m > 0) AS with_markers,
               count(*) FILTER (WHERE m > 1) AS with_several_markers, count(*) FILTER (WHERE t) AS missing_title, count(*) FILTER (WHERE dn) AS missing_document_number, count(*) FILTER (WHERE dt) AS missing_document_type,
               median(n) AS median_chars
        FROM (SELECT length({_tidy("text")}) AS n, {_AUDIT_MARKS} AS m, {_blank("title")} AS t, {_blank("document_number")} AS dn, {_blank("document_type")} AS dt FROM documents)
    """,
    "q_field_completeness": " UNION ALL ".join(f"SELECT '{f}' AS field, count(*) FILTER (WHERE NOT {_blank(f)}) AS present, count(*) AS total FROM documents" for f in ("title", "document_type", "document_number", "effective_status", "license", "source", "lang")),
    "q_doc_type_histogram": "SELECT coalesce(nullif(document_type, ''), 'MISSING') AS document_type, count(*) AS count FROM documents GROUP BY 1",
    "q_marker_counts": f"SELECT doc_id, {_AUDIT_MARKS} AS markers FROM documents",
    "q_citation_signal": f"SELECT row_no, {_cites('output')} AS cites FROM sample_qa",
    "q_cross_source_overlap": " UNION ALL ".join(f"SELECT '{c}' AS key, count(*) AS shared FROM (SELECT {c} FROM synthetic_legal_articles WHERE {c} <> '' INTERSECT SELECT {c} FROM documents WHERE {c} <> '')" for c in ("title", "text", "license")),
    "q_turn_summary": f"""
        SELECT count(*) AS records, count(*) FILTER (WHERE u <> '') AS text_is_user_turn, count(*) FILTER (WHERE a <> '') AS assistant_turns, count(*) FILTER (WHERE a <> '' AND {_cites("a")}) AS citing_turns,
               CAST(sum(length(a)) AS BIGINT) AS assistant_chars, round_even(avg(length(a)) FILTER (WHERE a <> ''), 2) AS mean_assistant_chars, true AS all_text_is_user_turn FROM (SELECT {_tidy("instruction")} AS u, {_tidy("output")} AS a FROM sample_qa)
    """,
    "q_rejected_documents": f"{_DOCS} SELECT record_id AS parent_record_id, reason, array_to_string(missing, ',') AS missing_fields FROM parsed WHERE reason IS NOT NULL",
    "q_parse_warnings": f"{_DOCS} SELECT record_id AS parent_record_id, 'preamble_before_first_article' AS code FROM parsed WHERE reason IS NULL AND {_tidy('p[1]')} <> ''",
    "q_article_split": f"{_DOCS} SELECT record_id, article_pos, article_number, article_title, md5(text) AS text_md5, array_to_string(flags, ',') AS parse_flags FROM flagged",
    "q_chunk_articles": f"{_chunked(600)} SELECT record_id AS parent_record_id, article_pos, chunk_index, length(chunk) AS chars, substr(sha256(chunk), 1, 16) AS text_hash, array_to_string(own, ',') AS parse_flags FROM rows",
    "q_parse_metrics": f"""
        {_chunked(4000)}, marked AS (
            SELECT *, CASE WHEN coalesce(t, '') <> '' THEN len(string_split(regexp_replace(replace(raw, chr(1), ''), {_q(_MARKER)}, chr(1) || '\\0', 'g'), chr(1))) - 1 ELSE 0 END AS m FROM parsed
        ), docs AS (
            SELECT count(*) AS documents, count(reason) AS rejected_documents, count(*) FILTER (WHERE len(missing) = 0) AS good, count(*) FILTER (WHERE m > 0) AS documents_with_markers, count(*) FILTER (WHERE m = 0) AS documents_without_markers,
                   count(*) FILTER (WHERE m = 1) AS documents_with_one_article, count(*) FILTER (WHERE m > 1) AS documents_with_several_articles, count(*) FILTER (WHERE reason IS NULL AND {_tidy("p[1]")} <> '') AS warnings FROM marked
        ), parts AS (
            SELECT count(*) AS candidates, count(*) - count(DISTINCT substr(sha256(chunk), 1, 16)) AS duplicate_hashes, count(*) FILTER (WHERE length(chunk) = 0) AS empty, count(*) FILTER (WHERE length(chunk) <= 50) AS near_empty,
                   count(*) FILTER (WHERE length(chunk) < 100 OR length(chunk) > 50000) AS suspicious_length, count(article_number) AS numbered, count(*) FILTER (WHERE len(own) > 0) AS uncertain FROM rows
        )
        SELECT * EXCLUDE (good, numbered), round_even(good / documents, 6) AS provenance_coverage, round_even(numbered / candidates, 6) AS article_number_rate FROM docs, parts
    """,
    "q_round_robin_sample": f"""
        WITH r AS (SELECT *, sha256('42|keep:parent|' || coalesce(parent_record_id, '')) AS pr, row_number() OVER (PARTITION BY coalesce(parent_record_id, '') ORDER BY {_RANK.format(salt="keep").replace("article_hash", "coalesce(text_hash, '')")}, CAST(input_index AS VARCHAR)) AS turn FROM article_candidates)
        SELECT row_number() OVER (ORDER BY turn, pr, parent_record_id) AS sample_index, input_index, parent_record_id FROM r ORDER BY turn, pr, parent_record_id LIMIT 100
    """,
    "q_duplicate_representatives": f"""
        {_DECIDED} SELECT input_index, article_hash AS duplicate_group_key, group_size AS duplicate_group_size FROM decided WHERE group_size > 1
        QUALIFY row_number() OVER (PARTITION BY article_hash ORDER BY CASE WHEN filter_decision = 'reject_duplicate_hash' THEN 0 ELSE 1 END, {_RANK.format(salt="duplicate_related_group")}, CAST(input_index AS VARCHAR)) = 1
    """,
    "q_review_sample": f"""
        {_sample()} SELECT printf('phase2h-%s-%03d-%s', sampling_bucket, sample_index, substr(sha256('42|' || sampling_bucket || '|' || input_index), 1, 12)) AS review_sample_id, sampling_bucket, sample_index, input_index, candidate_id, chars AS text_length FROM sample
    """,
    "q_bucket_shortfalls": f"""
        {_sample()} SELECT b AS sampling_bucket, t AS target, count(input_index) AS selected, greatest(t - count(input_index), 0) AS shortfall
        FROM (VALUES ('duplicate_related', 10), ('suspicious_length', 10), ('keep_candidate_for_human_review', 60), ('needs_review', 50), ('rejected', 20)) w(b, t) LEFT JOIN sample ON sampling_bucket = b GROUP BY b, t
    """,
    "q_sample_coverage": f"""
        {_sample()}, full_rows AS (SELECT a.* FROM sample JOIN article_candidates a USING (input_index))
        SELECT count(*) AS sampled, count(DISTINCT CASE WHEN NOT {_blank('parent_record_id')} THEN parent_record_id END) AS parents_covered, count(DISTINCT CASE WHEN NOT {_blank('source_id')} THEN source_id END) AS source_ids_covered,
            array_to_string(list_sort(list(DISTINCT source_dataset) FILTER (WHERE NOT {_blank('source_dataset')})), ',') AS source_datasets, array_to_string(list_sort(list(DISTINCT license) FILTER (WHERE NOT {_blank('license')})), ',') AS licenses,
            CAST(0 AS BIGINT) AS with_parent_warning FROM full_rows
    """,
    "q_fixed_fields": """
        WITH r AS (SELECT source IS DISTINCT FROM 'template-drill' AS a, is_synthetic IS DISTINCT FROM true AS b, is_legal_ground_truth IS DISTINCT FROM false AS c, approved_for_rag_index IS DISTINCT FROM false AS d FROM sample_qa)
        SELECT count(*) AS rows, count(*) FILTER (WHERE a) AS wrong_source, count(*) FILTER (WHERE b) AS wrong_is_synthetic, count(*) FILTER (WHERE c) AS wrong_is_legal_ground_truth, count(*) FILTER (WHERE d) AS wrong_approved_for_rag_index,
            count(*) FILTER (WHERE a OR b OR c OR d) AS bad_rows, count(*) FILTER (WHERE a OR b OR c OR d) = 0 AND count(*) = 2000 AS as_expected FROM r
    """,
    "q_true_flags": " UNION ALL ".join(f"SELECT '{f}' AS flag, count(*) FILTER (WHERE lower({_tidy(f)}) IN ('true', '1', 'yes', 'y')) AS count FROM reviewer_decisions_completed" for f in ("legal_ground_truth_approved", "rag_index_approved")),
    "q_subset_consistency": f"""
        SELECT CASE bits WHEN 1 THEN 'reviews_only' WHEN 2 THEN 'candidates_only' ELSE 'both' END AS held_by, count(*) AS candidates FROM (
            SELECT candidate_id, bit_or(bit) AS bits FROM (SELECT candidate_id, 1 AS bit FROM reviewer_decisions_completed UNION ALL SELECT candidate_id, 2 FROM article_candidates) WHERE NOT {_blank('candidate_id')} GROUP BY 1) GROUP BY 1
    """,
    "q_reviewed_not_kept": f"""
        {_DECIDED} SELECT DISTINCT candidate_id FROM reviewer_decisions_completed r WHERE NOT {_blank('candidate_id')} AND candidate_id NOT IN (SELECT candidate_id FROM decided WHERE filter_decision = 'keep_candidate_for_human_review' AND candidate_id IS NOT NULL)
    """,
    "q_test_sample": "SELECT row_no, id FROM sample_qa WHERE split = 'test' ORDER BY sha256('42|' || CAST(row_no AS VARCHAR)) LIMIT 50",
    "q_duplicate_related": f"{_DECIDED} SELECT input_index, group_size FROM decided WHERE group_size > 1",
    "q_source_aliases": """
        WITH known AS (SELECT source_dataset AS name, source_dataset AS own FROM source_manifest UNION ALL SELECT * FROM (VALUES ('mock_archive', 'mock-archive'), ('drill', 'template-drill')))
        SELECT own AS source_dataset, count(*) AS records FROM documents d LEFT JOIN known ON lower(trim(d.source)) = name GROUP BY 1
    """,
    "q_phrase_policy": f"SELECT count(*) FILTER (WHERE {' OR '.join(f'contains(lower(text), {_q(x)})' for x in POLICY_PHRASES)}) AS any_phrase, count(*) FILTER (WHERE {' AND '.join(f'contains(lower(text), {_q(x)})' for x in ALL_PHRASES)}) AS all_phrases FROM documents",
    "q_split_overlaps": " UNION ALL ".join(
        f"SELECT '{a}' AS first, '{b}' AS second, count(*) AS shared FROM (SELECT DISTINCT id FROM sample_qa WHERE split = '{a}' AND id IS NOT NULL INTERSECT SELECT DISTINCT id FROM sample_qa WHERE split = '{b}')" for a, b in (("test", "train"), ("test", "validation"), ("train", "validation"))
    ),
    "q_review_validation": f"{_REVIEWS} SELECT review_row, candidate_id, array_to_string(reasons, '; ') AS reasons FROM v WHERE len(reasons) > 0",
    "q_review_invalid_reasons": f"{_REVIEWS} SELECT reason, count(*) AS count FROM (SELECT unnest(reasons) AS reason FROM v) GROUP BY reason",
    "q_adjudication": f"{_REVIEWS} SELECT candidate_id, review_count, array_to_string(reviewer_ids, ',') AS reviewer_ids, array_to_string(decision_labels, ',') AS decision_labels, array_to_string(confidence_values, ',') AS confidence_values, adjudication_status, consensus_label FROM adjudicated",
    "q_review_outcomes": f"{_REVIEWS} SELECT outcome, count(*) AS count FROM settled GROUP BY outcome",
    "q_label_audit": f"""
        {_REVIEWS} SELECT * FROM (SELECT count(*) AS rows, count(*) FILTER (WHERE len(reasons) = 0) AS valid_rows, count(*) FILTER (WHERE len(reasons) > 0) AS invalid_rows,
            count(*) FILTER (WHERE lower(legal_ground_truth_approved) IN ('true', '1', 'yes', 'y') OR lower(rag_index_approved) IN ('true', '1', 'yes', 'y')) AS forbidden_flags,
            count(DISTINCT reviewer_id) FILTER (WHERE len(reasons) = 0) AS reviewers, count(*) FILTER (WHERE candidate_id = '') AS missing_candidate_ids,
            count(*) FILTER (WHERE lower(legal_ground_truth_approved) IN ('true', '1', 'yes', 'y')) AS legal_ground_truth_true, count(*) FILTER (WHERE lower(rag_index_approved) IN ('true', '1', 'yes', 'y')) AS rag_index_true,
            round_even(count(*) FILTER (WHERE len(reasons) = 0 AND confidence = 'low') / count(*) FILTER (WHERE len(reasons) = 0), 6) AS low_confidence_rate FROM v),
        (SELECT count(*) AS candidates, count(*) FILTER (WHERE review_count > 1) AS reviewed_more_than_once, count(*) FILTER (WHERE outcome = 'accepted') AS accepted,
            count(*) FILTER (WHERE outcome = 'rejected') AS rejected, count(*) FILTER (WHERE outcome = 'unresolved') AS unresolved, count(*) FILTER (WHERE adjudication_status = 'label_conflict_requires_adjudication') AS label_conflicts FROM settled)
    """,
    "q_label_counts": f"{_REVIEWS} SELECT 'decision_label' AS field, decision_label AS value, count(*) AS count FROM v WHERE len(reasons) = 0 GROUP BY 2 UNION ALL SELECT 'confidence', confidence, count(*) FROM v WHERE len(reasons) = 0 GROUP BY 2",
    "q_filter_risk_flags": f"{_RISK} SELECT risk_flag, count(*) AS count FROM flags WHERE risk_flag IS NOT NULL GROUP BY risk_flag",
    "q_manifest_join": f"{_MANIFEST} SELECT * REPLACE (array_to_string(problems, ',') AS problems, array_to_string(missing_fields, ',') AS missing_fields) FROM joined",
    "q_manifest_metrics": f"""
        {_MANIFEST} SELECT count(*) AS accepted_in, count(*) FILTER (WHERE ok) AS written, count(*) FILTER (WHERE len(problems) > 0) AS rejected, count(*) FILTER (WHERE len(problems) = 0 AND len(missing_fields) > 0) AS unresolved,
            count(DISTINCT nullif(parent_record_id, '')) FILTER (WHERE ok) AS parents, count(DISTINCT nullif(reviewer_id, '')) FILTER (WHERE ok) AS reviewers, count(DISTINCT nullif(source_id, '')) FILTER (WHERE ok) AS source_ids, count(DISTINCT nullif(source_dataset, '')) FILTER (WHERE ok) AS source_datasets,
            count(*) FILTER (WHERE list_contains(problems, 'missing_completed_review_row')) AS without_review, count(*) FILTER (WHERE list_contains(problems, 'missing_review_sample_row')) AS without_sample,
            count(*) FILTER (WHERE list_contains(problems, 'review_decision_not_accept_for_later_corpus_candidate')) AS unlike_review, count(*) FILTER (WHERE list_contains(problems, 'review_row_legal_ground_truth_approved_true')) AS legal_ground_truth_true,
            count(*) FILTER (WHERE list_contains(problems, 'review_row_rag_index_approved_true')) AS rag_index_true, count(*) FILTER (WHERE list_contains(missing_fields, 'filter_version')) AS without_filter_version,
            true AS counts_reconcile FROM (SELECT *, len(problems) = 0 AND len(missing_fields) = 0 AS ok FROM joined)
    """,
    "q_manifest_counts": f"""
        {_MANIFEST}, fine AS (SELECT * FROM joined WHERE len(problems) = 0 AND len(missing_fields) = 0)
        SELECT 'decision_label' AS field, decision_label AS value, count(*) AS count FROM fine GROUP BY 2 UNION ALL SELECT 'confidence', confidence, count(*) FROM fine GROUP BY 2
    """,
    "q_accepted_counts": f"SELECT count(*) AS accepted_rows, count(DISTINCT {_trim('candidate_id')}) AS accepted_candidates, count(*) - count(DISTINCT {_trim('candidate_id')}) AS repeated_rows FROM reviewer_decisions_completed WHERE lower({_tidy('decision_label')}) = 'accept_for_later_corpus_candidate' AND NOT {_blank('candidate_id')}",
    "q_provenance_coverage": f"""
        SELECT count(*) AS rows, count(*) FILTER (WHERE ok) AS covered, round_even(count(*) FILTER (WHERE ok) / count(*), 6) AS coverage
        FROM (SELECT NOT ({" OR ".join(_blank(f) for f in ("candidate_id", "parent_record_id", "source_dataset", "license", "text_hash", "parser_version"))} OR ({_blank("source_id")} AND {_blank("source_url")})) AS ok FROM article_candidates)
    """,
    "q_first_occurrences": f"SELECT {_trim('candidate_id')} AS candidate_id, min(review_row) AS first_seen, count(*) - 1 AS repeats FROM reviewer_decisions_completed WHERE NOT {_blank('candidate_id')} GROUP BY 1",
    "q_instruction_errors": f"SELECT row_no, coalesce({_first_text_error()}, array_to_string({_VALID}, '; ')) AS errors FROM sample_qa",
    "q_instruction_issues": f"SELECT issue, count(*) AS count FROM (SELECT unnest(CASE WHEN {_first_text_error()} IS NOT NULL THEN [{_first_text_error()}] ELSE {_VALID} END) AS issue FROM sample_qa) GROUP BY issue",
    "q_instruction_audit": f"""
        WITH e AS (SELECT CASE WHEN {_first_text_error()} IS NOT NULL THEN [{_first_text_error()}] ELSE {_VALID} END AS errors FROM sample_qa), x AS (SELECT unnest(errors) AS m FROM e)
        SELECT * FROM (SELECT count(*) AS total_rows, count(*) FILTER (WHERE len(errors) = 0) AS valid_rows, count(*) FILTER (WHERE len(errors) > 0) AS invalid_rows, CAST(sum(len(errors)) AS BIGINT) AS errors FROM e),
        (SELECT count(*) FILTER (WHERE contains(m, 'official legal authority')) AS official_authority_claims, count(*) FILTER (WHERE contains(m, 'source must equal template-drill')) AS source_mismatches,
            count(*) FILTER (WHERE contains(m, 'is_synthetic must be true')) AS synthetic_false, count(*) FILTER (WHERE contains(m, 'is_legal_ground_truth must be false')) AS legal_ground_truth_true,
            count(*) FILTER (WHERE contains(m, 'approved_for_rag_index must be false')) AS rag_index_true, count(*) FILTER (WHERE contains(m, 'disclaimer')) AS disclaimer_issues FROM x)
    """,
    "q_instruction_duplicates": " UNION ALL ".join(
        f"SELECT '{m}' AS measure, count(*) - count(DISTINCT {e}) AS duplicates FROM sample_qa"
        for m, e in {**{c: f"coalesce({c}, '')" for c in ("id", "instruction", "input", "output")}, "instruction_input_output": "(coalesce(instruction, ''), coalesce(input, ''), coalesce(output, ''))"}.items()
    ),
    "q_instruction_distribution": "SELECT task_type, difficulty, count(*) AS rows FROM sample_qa GROUP BY 1, 2",
    "q_split_assignment": f"{_SPLIT} SELECT row_no, split_name FROM s",
    "q_split_sizes": f"{_SPLIT} SELECT split_name, count(*) AS rows FROM s GROUP BY 1",
    "q_prompt_format": f"SELECT row_no, md5({_HEAD} || {_tidy('output')}) AS training_md5, md5({_HEAD}) AS inference_md5 FROM sample_qa",
    "q_overlap_score": f"""
        SELECT row_no, length({_tidy("input")}) > 10 AS format_valid, round(len(list_intersect(e, r)) / greatest(len(e), 1), 6) AS overlap, len(list_intersect(e, r)) / greatest(len(e), 1) >= 0.15 AS task_pass
        FROM (SELECT row_no, input, [w FOR w IN list_distinct(regexp_split_to_array(lower(coalesce(output, '')), '{_WS}+')) IF w <> ''] AS e, [w FOR w IN list_distinct(regexp_split_to_array(lower(coalesce(input, '')), '{_WS}+')) IF w <> ''] AS r FROM sample_qa)
    """,
    "q_overlap_means": f"""
        SELECT round_even(avg(CAST(length({_tidy("input")}) > 10 AS INTEGER)), 6) AS format_valid_rate, round_even(avg(CAST(len(list_intersect(e, r)) / greatest(len(e), 1) >= 0.15 AS INTEGER)), 6) AS task_pass_rate
        FROM (SELECT row_no, input, [w FOR w IN list_distinct(regexp_split_to_array(lower(coalesce(output, '')), '{_WS}+')) IF w <> ''] AS e, [w FOR w IN list_distinct(regexp_split_to_array(lower(coalesce(input, '')), '{_WS}+')) IF w <> ''] AS r FROM sample_qa)
    """,
    "q_task_notes": f"SELECT task_type, count(*) AS count, CASE task_type {' '.join(f'WHEN {_q(k)} THEN {_q(v)}' for k, v in TASK_NOTES.items())} END AS note FROM sample_qa WHERE task_type IN {_listed(list(TASK_NOTES))} GROUP BY task_type",
    "q_contract_errors": f"""
        SELECT record_no, CASE WHEN length(title) > 80 THEN substr(title, 1, 77) || '...' ELSE title END AS title, array_to_string(errors, '; ') AS errors FROM (SELECT record_no, title, [x FOR x IN [
            CASE WHEN coalesce(article_number < 1, true) THEN 'article_number must be at least 1' END, CASE WHEN {_blank("text")} THEN 'text must not be blank' END,
            CASE WHEN doc_type NOT IN {_listed(DOCUMENT_TYPES)} THEN 'doc_type is not listed' END, CASE WHEN status NOT IN {_listed(STATUSES)} THEN 'status is not listed' END,
            CASE WHEN len([c FOR c IN clauses IF coalesce(c.clause_number, '') = '']) > 0 THEN 'clause_number must not be empty' END, CASE WHEN len([c FOR c IN clauses IF {_blank("c.text")}]) > 0 THEN 'clause text must not be blank' END,
            CASE WHEN len([c FOR c IN clauses IF c.article_number < 1]) > 0 THEN 'clause article_number must be at least 1' END, CASE WHEN len([c FOR c IN clauses IF c.doc_type NOT IN {_listed(DOCUMENT_TYPES)}]) > 0 THEN 'clause doc_type is not listed' END,
            CASE WHEN len([c FOR c IN clauses IF c.status NOT IN {_listed(STATUSES)}]) > 0 THEN 'clause status is not listed' END] IF x IS NOT NULL] AS errors FROM synthetic_legal_articles) WHERE len(errors) > 0
    """,
    "q_policy_lines": f"""
        SELECT doc_id, line_no, phrase FROM (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS line_no FROM (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '\\r\\n|\\n|\\r|\\x0B|\\x0C|\\x{{85}}|\\x{{2028}}|\\x{{2029}}') AS lines FROM documents)),
        (SELECT unnest([{", ".join(map(_q, POLICY_PHRASES))}]) AS phrase) WHERE NOT starts_with(ltrim(line), '#') AND contains(lower(line), lower(phrase))
    """,
    "q_template_rows": f"SELECT i AS index, printf('synthetic-demo-%06d', i) AS id, {_fill('instruction')} AS instruction, {_fill('input')} AS input, {_fill('output')} AS output FROM range(1, 2501) t(i)",
}
ORACLE_SQL["q_contract_summary"] = f"""
    WITH bad AS ({ORACLE_SQL["q_contract_errors"]})
    SELECT (SELECT count(*) FROM synthetic_legal_articles) - count(*) AS ok, count(*) AS broken,
        count(*) = 0 AND (SELECT bool_and(coalesce(is_synthetic_example, false) AND coalesce(source_dataset, '') = 'synthetic_example') FROM synthetic_legal_articles) AS synthetic_only FROM bad
"""
