"""The same results in plain SQL over the benchmark tables, for an independent engine.

Fixed values: the labels, check names, expectations and notes in these texts are those of the results.
"""

from __future__ import annotations

from tidemark.workload.fixtures import WATERMARK, ctes

_W = f"DATE '{WATERMARK}'"


def _keys(dataset: str, source: str, target: str, key: str) -> list[str]:
    missing = f"(SELECT {key} AS k FROM {source} EXCEPT SELECT {key} FROM {target})"
    stale = f"(SELECT {key} AS k FROM {target} EXCEPT SELECT {key} FROM {source})"

    def listed(keys: str) -> str:
        first = f"(SELECT CAST(k AS VARCHAR) AS t FROM {keys} x ORDER BY t LIMIT 5)"
        return f"'[' || coalesce((SELECT string_agg('''' || t || '''', ', ' ORDER BY t) FROM {first} y), '') || ']'"

    return [
        f"""SELECT 'source_key_parity' AS check_name, '{dataset}' AS dataset, 'completeness' AS dimension,
            CASE WHEN m + s > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
            (SELECT count(DISTINCT {key}) FROM {source}) || ' source keys; 0 missing; 0 stale' AS expected,
            (SELECT count(DISTINCT {key}) FROM {target}) || ' warehouse keys; ' || m || ' missing; ' || s || ' stale' AS actual,
            'missing_sample=' || {listed(missing)} || '; stale_sample=' || {listed(stale)} AS details
            FROM (SELECT (SELECT count(*) FROM {missing} a) AS m, (SELECT count(*) FROM {stale} b) AS s)""",
        f"""SELECT 'unique_primary_key', '{dataset}', 'uniqueness', CASE WHEN d = 0 THEN 'PASS' ELSE 'FAIL' END,
            '0 duplicates', d || ' duplicates', '' FROM (SELECT count(*) - count(DISTINCT {key}) AS d FROM {target})""",
        f"""SELECT 'null_key', '{dataset}', 'completeness', CASE WHEN d = 0 THEN 'PASS' ELSE 'FAIL' END,
            '0 null keys', d || ' null keys', '' FROM (SELECT count(*) FILTER (WHERE {key} IS NULL) AS d FROM {target})""",
    ]


def _nulls(columns: str) -> dict[str, str]:
    return {f"{c}_not_null": f"count(*) FILTER (WHERE {c} IS NULL)" for c in columns.split()}


def _constraints(dataset: str, table: str, rules: dict[str, str]) -> str:
    counted = ", ".join(f"{count} AS {rule}" for rule, count in rules.items())
    broken = ", ".join(f"CASE WHEN {r} > 0 THEN '{r}=' || {r} END" for r in sorted(rules))
    return f"""SELECT 'source_constraints', '{dataset}', 'validity', CASE WHEN {" + ".join(rules)} > 0 THEN 'FAIL' ELSE 'PASS' END,
        '0 violations', ({" + ".join(rules)}) || ' violations', concat_ws('; ', {broken}) FROM (SELECT {counted} FROM {table})"""


def _orphans(check: str, dataset: str, counted: str) -> str:
    return f"""SELECT '{check}', '{dataset}', 'consistency', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END,
        '0 orphans', n || ' orphans', '' FROM {counted}"""


def _contacts(check: str, sound: str) -> str:
    return f"""SELECT '{check}', 'customers_raw', 'validity', CASE WHEN n > 0 THEN 'WARN' ELSE 'PASS' END,
        'tracked, not silently fixed', CAST(n AS VARCHAR), 'raw value preserved; validity flag is exposed in master'
        FROM (SELECT count(*) AS n FROM stored_contacts WHERE NOT {sound})"""


# --- reusable common table expressions, each naming what it builds on -------------------------

_PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "protected": (
        ("fx_advances",),
        "SELECT DISTINCT customer_id FROM fx_advances WHERE status IN ('funded', 'paid_off')",
    ),
    "people": (
        ("fx_customers", "protected"),
        """SELECT c.*, nullif(regexp_replace(upper(c.government_id), '[^A-Z0-9]', '', 'g'), '') AS proof_key,
               c.customer_id IN (SELECT customer_id FROM protected) AS is_protected,
               nullif(lower(trim(c.email)), '') AS clean_email,
               (CASE WHEN c.government_id <> '' THEN 1 ELSE 0 END + CASE WHEN c.first_name <> '' THEN 1 ELSE 0 END
                + CASE WHEN c.last_name <> '' THEN 1 ELSE 0 END + CASE WHEN c.birth_date IS NOT NULL THEN 1 ELSE 0 END
                + CASE WHEN c.email <> '' THEN 1 ELSE 0 END + CASE WHEN c.phone <> '' THEN 1 ELSE 0 END) AS score
           FROM fx_customers c WHERE NOT c.is_test""",
    ),
    "ranked": (
        ("people",),
        """SELECT *, count(*) OVER g AS n_members, sum(CASE WHEN is_protected THEN 1 ELSE 0 END) OVER g AS n_protected,
               first_value(customer_id) OVER (PARTITION BY proof_key
                   ORDER BY CASE WHEN is_protected THEN 0 ELSE 1 END, score DESC, created_at, customer_id) AS first_id
           FROM people WINDOW g AS (PARTITION BY proof_key)""",
    ),
    "resolved": (
        ("ranked",),
        """SELECT *, CASE WHEN proof_key IS NULL OR n_protected > 1 THEN customer_id ELSE first_id END AS master_id,
               CASE WHEN proof_key IS NULL THEN 'no_proven_identity' WHEN n_protected > 1 THEN 'protected_conflict'
                    WHEN n_protected = 1 THEN 'government_id+protected_advance'
                    ELSE 'government_id+deterministic_survivor' END AS rule
           FROM ranked""",
    ),
    "filled": (
        ("resolved",),
        """SELECT r.customer_id, r.first_name, r.last_name, r.is_protected,
               CASE WHEN r.government_id <> '' THEN r.government_id ELSE
                   (SELECT o.government_id FROM resolved o WHERE o.master_id = r.customer_id AND o.government_id <> ''
                    ORDER BY o.updated_at, o.customer_id LIMIT 1) END AS government_id,
               CASE WHEN r.birth_date IS NOT NULL THEN r.birth_date ELSE
                   (SELECT o.birth_date FROM resolved o WHERE o.master_id = r.customer_id AND o.birth_date IS NOT NULL
                    ORDER BY o.updated_at, o.customer_id LIMIT 1) END AS birth_date,
               CASE WHEN r.email <> '' THEN r.email ELSE
                   (SELECT o.email FROM resolved o WHERE o.master_id = r.customer_id AND o.email <> ''
                    ORDER BY o.updated_at, o.customer_id LIMIT 1) END AS email,
               CASE WHEN r.phone <> '' THEN r.phone ELSE
                   (SELECT o.phone FROM resolved o WHERE o.master_id = r.customer_id AND o.phone <> ''
                    ORDER BY o.updated_at, o.customer_id LIMIT 1) END AS phone,
               (SELECT count(*) FROM resolved o WHERE o.master_id = r.customer_id) AS n
           FROM resolved r WHERE r.master_id = r.customer_id""",
    ),
    "evidence": (
        ("resolved",),
        """SELECT customer_id, master_id, clean_email, birth_date FROM resolved
           WHERE birth_date IS NOT NULL AND regexp_full_match(clean_email, '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{2,}')""",
    ),
    "pairs": (
        ("evidence",),
        """SELECT a.clean_email, a.birth_date, a.customer_id AS a_id, b.customer_id AS b_id
           FROM evidence a JOIN evidence b ON a.clean_email = b.clean_email AND a.birth_date = b.birth_date
               AND a.customer_id < b.customer_id AND a.master_id <> b.master_id""",
    ),
    "groups": (
        ("evidence", "pairs"),
        """SELECT e.clean_email, e.birth_date, count(*) AS members, count(DISTINCT e.master_id) AS masters
           FROM evidence e GROUP BY 1, 2 HAVING count(DISTINCT e.master_id) > 1""",
    ),
    "remapped": (
        ("fx_cards", "resolved"),
        """SELECT c.card_id, r.master_id, c.customer_id, c.token, c.last_four, c.status
           FROM fx_cards c JOIN resolved r ON r.customer_id = c.customer_id""",
    ),
    "upper": (("fx_src_orders",), "SELECT max(updated_at) AS bound FROM fx_src_orders"),
    "delta": (
        ("fx_src_orders", "upper"),
        f"SELECT s.* FROM fx_src_orders s, upper u WHERE s.updated_at > {_W} AND s.updated_at <= u.bound",
    ),
    "upserted": (
        ("fx_tgt_orders", "delta"),
        """SELECT * FROM fx_tgt_orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM delta)
           UNION ALL SELECT * FROM delta""",
    ),
    "reconciled": (
        ("upserted", "fx_src_orders"),
        "SELECT * FROM upserted WHERE o_orderkey IN (SELECT o_orderkey FROM fx_src_orders)",
    ),
    "missing": (
        ("fx_src_orders", "fx_tgt_orders"),
        "SELECT o_orderkey FROM fx_src_orders EXCEPT SELECT o_orderkey FROM fx_tgt_orders",
    ),
    "stale": (
        ("fx_src_orders", "fx_tgt_orders"),
        "SELECT o_orderkey FROM fx_tgt_orders EXCEPT SELECT o_orderkey FROM fx_src_orders",
    ),
    "samples": (
        ("missing", "stale"),
        """SELECT 'missing' AS side, CAST(o_orderkey AS VARCHAR) AS key_text,
               row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) AS rn FROM missing
           UNION ALL SELECT 'stale', CAST(o_orderkey AS VARCHAR),
               row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) FROM stale""",
    ),
    "orphans_cards": (
        ("fx_cards", "fx_customers"),
        """SELECT count(*) AS n FROM fx_cards c LEFT JOIN fx_customers p ON p.customer_id = c.customer_id
           WHERE p.customer_id IS NULL""",
    ),
    "orphans_advances": (
        ("fx_advances", "fx_customers"),
        """SELECT count(*) AS n FROM fx_advances a LEFT JOIN fx_customers p ON p.customer_id = a.customer_id
           WHERE p.customer_id IS NULL""",
    ),
    "orphans_transactions": (
        ("fx_transactions", "fx_advances"),
        """SELECT count(*) AS n FROM fx_transactions t LEFT JOIN fx_advances p ON p.advance_id = t.advance_id
           WHERE p.advance_id IS NULL""",
    ),
    "orphans_cards_master": (
        ("remapped", "filled"),
        """SELECT count(*) AS n FROM remapped c LEFT JOIN filled p ON p.customer_id = c.master_id
           WHERE p.customer_id IS NULL""",
    ),
    "contacts": (
        ("fx_customers",),
        """SELECT coalesce(regexp_full_match(lower(trim(email)), '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{2,}'), false) AS ok_email,
               coalesce(length(regexp_replace(phone, '[^0-9]', '', 'g')) BETWEEN 8 AND 15 AND len(list_distinct(
                   string_split(regexp_replace(phone, '[^0-9]', '', 'g'), ''))) > 1, false) AS ok_phone
           FROM fx_customers WHERE NOT is_test""",
    ),
    "leaked": (
        ("fx_customers", "resolved"),
        """SELECT count(*) AS n FROM fx_customers c JOIN resolved r ON r.customer_id = c.customer_id WHERE c.is_test""",
    ),
    "moved": (
        ("protected", "resolved"),
        """SELECT count(*) AS n FROM protected p JOIN resolved r ON r.customer_id = p.customer_id
           WHERE r.master_id <> p.customer_id""",
    ),
    "backwards": (
        ("fx_history",),
        """SELECT count(*) AS n FROM (SELECT changed_at, lag(changed_at) OVER (PARTITION BY advance_id
               ORDER BY history_id, changed_at) AS before FROM fx_history) WHERE changed_at < before""",
    ),
    "verdicts": (
        ("fx_customers", "fx_advances", "fx_cards", "fx_transactions", "fx_history", "fx_stored_customers", "fx_stored_advances",
         "fx_stored_cards", "fx_stored_transactions", "fx_stored_history", "stored_orphans_cards", "stored_orphans_advances",
         "stored_orphans_transactions", "orphans_cards_master", "resolved", "stored_leaked", "stored_moved", "pairs",
         "stored_contacts", "stored_backwards"),
        " UNION ALL ".join([
            *_keys("customers_raw", "fx_customers", "fx_stored_customers", "customer_id"),
            *_keys("advances_raw", "fx_advances", "fx_stored_advances", "advance_id"),
            *_keys("cards_raw", "fx_cards", "fx_stored_cards", "card_id"),
            *_keys("transactions_raw", "fx_transactions", "fx_stored_transactions", "transaction_id"),
            *_keys("advance_status_history_raw", "fx_history", "fx_stored_history", "history_id"),
            _constraints("customers_raw", "fx_stored_customers", _nulls("first_name last_name is_test created_at updated_at")),
            _constraints("advances_raw", "fx_stored_advances", _nulls("customer_id status amount_cents created_at updated_at") | {
                "status_in_enum": "count(*) FILTER (WHERE (status IN ('requested', 'funded', 'paid_off', 'cancelled')) IS NOT TRUE)",
                "amount_not_negative": "count(*) FILTER (WHERE (amount_cents >= 0) IS NOT TRUE)"}),
            _constraints("cards_raw", "fx_stored_cards", _nulls("customer_id token last_four status") | {
                "last_four_length": "count(*) FILTER (WHERE (length(last_four) = 4) IS NOT TRUE)",
                "token_unique": "count(token) - count(DISTINCT token)"}),
            _constraints("transactions_raw", "fx_stored_transactions",
                _nulls("advance_id transaction_type amount_cents occurred_at updated_at")),
            _constraints("advance_status_history_raw", "fx_stored_history", _nulls("advance_id status changed_at")),
            """SELECT 'monotonic_sequence', 'advance_status_history_raw', 'consistency', CASE WHEN n > 0 THEN 'WARN' ELSE 'PASS' END,
                '0 decreases', n || ' decreases', '' FROM stored_backwards""",
            _orphans("cards_have_customer", "cards_raw", "stored_orphans_cards"),
            _orphans("advances_have_customer", "advances_raw", "stored_orphans_advances"),
            _orphans("transactions_have_advance", "transactions_raw", "stored_orphans_transactions"),
            _orphans("cards_have_master", "cards_master", "orphans_cards_master"),
            """SELECT 'alias_coverage', 'customer_alias', 'completeness', CASE WHEN a = c THEN 'PASS' ELSE 'FAIL' END,
                CAST(c AS VARCHAR), CAST(a AS VARCHAR), '' FROM (SELECT (SELECT count(*) FROM resolved) AS a,
                (SELECT count(*) FROM fx_stored_customers WHERE NOT is_test) AS c)""",
            """SELECT 'test_data_excluded', 'customer_master', 'validity', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END,
                '0', CAST(n AS VARCHAR), '' FROM stored_leaked""",
            """SELECT 'protected_customer_survives', 'customer_master', 'business_rule',
                CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, '0 protected customers remapped', n || ' remapped', '' FROM stored_moved""",
            """SELECT 'protected_identity_conflicts', 'identity_conflicts', 'business_rule',
                CASE WHEN n > 0 THEN 'WARN' ELSE 'PASS' END, '0 preferred', CAST(n AS VARCHAR),
                'conflicts are quarantined, never auto-merged'
                FROM (SELECT count(DISTINCT proof_key) AS n FROM resolved WHERE rule = 'protected_conflict' AND is_protected)""",
            """SELECT 'suggestive_match_candidates', 'identity_review_candidates', 'observability',
                CASE WHEN n > 0 THEN 'WARN' ELSE 'PASS' END, 'review only', CAST(n AS VARCHAR),
                'suggestive evidence is deliberately not auto-merged' FROM (SELECT count(*) AS n FROM pairs)""",
            _contacts("malformed_email_count", "ok_email"),
            _contacts("malformed_phone_count", "ok_phone"),
        ]),
    ),
}


def _on_stored(name: str) -> tuple[tuple[str, ...], str]:
    """A part over the stored copies of the raw tables instead of their sources."""
    needed, text = _PARTS[name]
    raw = [n for n in needed if n.startswith("fx_")]
    for n in raw:
        text = text.replace(n, n.replace("fx_", "fx_stored_"))
    return tuple(n.replace("fx_", "fx_stored_") if n in raw else n for n in needed), text


_PARTS |= {f"stored_{n}": _on_stored(n) for n in ("orphans_cards", "orphans_advances", "orphans_transactions", "contacts", "leaked", "backwards", "protected")}
_PARTS["stored_moved"] = (("stored_protected", "resolved"), _PARTS["moved"][1].replace("FROM protected", "FROM stored_protected"))


def _with(body: str, *needed: str) -> str:
    """``body`` under the common table expressions it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for other in _PARTS.get(name, ((), ""))[0]:
            visit(other)
        order.append(name)

    for n in needed:
        visit(n)
    texts = [f"{n} AS ({_PARTS[n][1]})" if n in _PARTS else ctes(n)[0] for n in order]
    return f"WITH {', '.join(texts)} {body}"


def _piece(c: str) -> str:
    text = f"CAST({c} AS VARCHAR)"
    return f"coalesce(CAST(length({text}) AS VARCHAR) || ':' || {text}, '-')"


_ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "amount_cents", "updated_at")
_ROW_TEXT = " || ".join(_piece(c) for c in _ORDER_COLUMNS)
_BYTES = " + ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)), 4)" for c in _ORDER_COLUMNS)


def _digest(name: str) -> str:
    return f"""SELECT '{name}' AS table_name, count(*) AS row_count,
        CAST(coalesce(sum(CAST(CAST('0x' || substr(sha256({_ROW_TEXT}), 1, 15) AS BIGINT) AS HUGEINT)), 0) AS VARCHAR) AS checksum"""


_EMAIL_OK = "coalesce(regexp_full_match(lower(trim(email)), '[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{2,}'), false)"
_DIGITS = "regexp_replace(phone, '[^0-9]', '', 'g')"
_SNAPSHOT = "o_orderkey, o_custkey, o_orderstatus, amount_cents, CAST(updated_at AS VARCHAR) AS updated_at"

_LATEST = """SELECT transaction_id, advance_id, transaction_type, amount_cents, occurred_at, updated_at FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY updated_at DESC, amount_cents DESC,
        advance_id DESC, transaction_type DESC, occurred_at DESC) AS rn FROM fx_transactions) WHERE rn = 1"""


def _iso(c: str) -> str:
    return f"""CASE WHEN microsecond({c}) % 1000000 = 0 THEN strftime({c}, '%Y-%m-%dT%H:%M:%S')
        ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') END"""


ORACLE: dict[str, str] = {
    "incremental_extract": f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
        CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM orders
        WHERE o_orderdate > {_W} AND o_orderdate <= (SELECT max(o_orderdate) FROM orders)""",
    "upper_bound": "SELECT CAST(max(o_orderdate) AS VARCHAR) AS bound FROM orders",
    "latest_per_key": _with(
        f"""SELECT transaction_id, advance_id, transaction_type, amount_cents, CAST(occurred_at AS VARCHAR) AS occurred_at,
            CAST(updated_at AS VARCHAR) AS updated_at FROM ({_LATEST})""",
        "fx_transactions",
    ),
    "generated_transactions": """SELECT l_orderkey AS advance_id, CAST(n AS INT) AS installment,
        CASE WHEN n = l_linenumber THEN 'repayment' ELSE 'disbursement' END AS transaction_type,
        CAST(ROUND(l_extendedprice * 100) AS BIGINT) // l_linenumber AS amount_cents,
        CAST(l_shipdate + to_minutes(n) AS VARCHAR) AS occurred_at
        FROM (SELECT *, unnest(generate_series(1, l_linenumber)) AS n FROM lineitem)""",
    "insert_select_history": _with(
        """SELECT history_id, advance_id, status, CAST(changed_at AS VARCHAR) AS changed_at FROM (
            SELECT * FROM fx_history UNION ALL SELECT advance_id + (SELECT max(history_id) + 1 FROM fx_history),
                advance_id, status, updated_at FROM fx_advances)""",
        "fx_history", "fx_advances",
    ),
    "non_test_customers": _with(
        "SELECT customer_id, first_name, last_name FROM fx_customers WHERE NOT is_test", "fx_customers"
    ),
    "normalize_government_id": _with(
        """SELECT customer_id, government_id,
            nullif(regexp_replace(upper(government_id), '[^A-Z0-9]', '', 'g'), '') AS normalized FROM fx_customers""",
        "fx_customers",
    ),
    "normalize_email": _with(
        "SELECT customer_id, email, nullif(lower(trim(email)), '') AS normalized FROM fx_customers", "fx_customers"
    ),
    "valid_email": _with(f"SELECT customer_id, email, {_EMAIL_OK} AS is_valid FROM fx_customers", "fx_customers"),
    "valid_phone": _with(
        f"""SELECT customer_id, phone, coalesce(length({_DIGITS}) BETWEEN 8 AND 15
            AND len(list_distinct(string_split({_DIGITS}, ''))) > 1, false) AS is_valid FROM fx_customers""",
        "fx_customers",
    ),
    "completeness_score": _with(
        """SELECT customer_id, CAST((government_id <> '') IS TRUE AS INT) + CAST((first_name <> '') IS TRUE AS INT)
            + CAST((last_name <> '') IS TRUE AS INT) + CAST(birth_date IS NOT NULL AS INT)
            + CAST((email <> '') IS TRUE AS INT) + CAST((phone <> '') IS TRUE AS INT) AS score FROM fx_customers""",
        "fx_customers",
    ),
    "row_to_json": """SELECT c_custkey, CAST(to_json({'c_custkey': c_custkey, 'c_name': c_name, 'c_nationkey': c_nationkey,
        'c_mktsegment': nullif(c_mktsegment, 'BUILDING')}) AS VARCHAR) AS payload FROM customer""",
    "protected_customers": _with("SELECT customer_id FROM protected", "protected"),
    "protected_flag": _with("SELECT customer_id, is_protected FROM people", "people"),
    "identity_groups": _with(
        """SELECT proof_key, count(*) AS n_members, count(*) FILTER (WHERE is_protected) AS n_protected
            FROM people WHERE proof_key IS NOT NULL GROUP BY proof_key""",
        "people",
    ),
    "survivors": _with(
        """SELECT DISTINCT proof_key, master_id AS master_customer_id, rule AS resolution_rule FROM resolved
            WHERE proof_key IS NOT NULL AND n_protected <= 1""",
        "resolved",
    ),
    "customer_alias": _with(
        "SELECT customer_id AS source_customer_id, master_id AS master_customer_id, rule AS resolution_rule FROM resolved",
        "resolved",
    ),
    "customer_master": _with(
        f"""SELECT customer_id AS master_customer_id, government_id, first_name, last_name,
            CAST(birth_date AS VARCHAR) AS birth_date, email, phone, {_EMAIL_OK} AS email_valid,
            coalesce(length({_DIGITS}) BETWEEN 8 AND 15 AND len(list_distinct(string_split({_DIGITS}, ''))) > 1, false)
                AS phone_valid,
            is_protected AS protected_by_advance, CAST(n AS INT) AS source_record_count FROM filled""",
        "filled",
    ),
    "identity_conflicts": _with(
        """SELECT proof_key AS conflict_key, customer_id, 'multiple protected customers share proven identity' AS reason
            FROM resolved WHERE rule = 'protected_conflict' AND is_protected""",
        "resolved",
    ),
    "review_groups": _with(
        """SELECT g.clean_email AS email, CAST(g.birth_date AS VARCHAR) AS birth_date, g.members, g.masters,
            CAST((SELECT count(*) FROM pairs p WHERE p.clean_email = g.clean_email AND p.birth_date = g.birth_date)
                AS VARCHAR) AS pairs FROM groups g""",
        "groups",
    ),
    "review_members": _with(
        """SELECT e.clean_email AS email, CAST(e.birth_date AS VARCHAR) AS birth_date, e.customer_id,
            e.master_id AS master_customer_id
            FROM evidence e JOIN groups g ON g.clean_email = e.clean_email AND g.birth_date = e.birth_date""",
        "groups",
    ),
    "review_partners": _with(
        """SELECT a_id AS customer_id_a, b_id AS customer_id_b, 'email+birth_date' AS evidence,
            'suggestive evidence is not proof' AS reason_not_merged
            FROM pairs WHERE a_id % 100 = 0 OR b_id % 100 = 0""",
        "pairs",
    ),
    "cards_master": _with(
        """SELECT card_id, master_id AS master_customer_id, customer_id AS source_customer_id, token, last_four, status
            FROM remapped""",
        "remapped",
    ),
    "identity_metrics": _with(
        """SELECT count(DISTINCT master_id) AS master_customers, count(*) AS aliases,
            count(*) FILTER (WHERE customer_id <> master_id) AS proven_merges,
            count(*) FILTER (WHERE rule = 'protected_conflict' AND is_protected) AS identity_conflicts FROM resolved""",
        "resolved",
    ),
    "orphan_cards": _with("SELECT n AS orphans FROM orphans_cards", "orphans_cards"),
    "orphan_advances": _with("SELECT n AS orphans FROM orphans_advances", "orphans_advances"),
    "orphan_transactions": _with("SELECT n AS orphans FROM orphans_transactions", "orphans_transactions"),
    "orphan_cards_master": _with("SELECT n AS orphans FROM orphans_cards_master", "orphans_cards_master"),
    "orphan_cards_before_remap": _with(
        "SELECT count(*) AS orphans FROM fx_cards WHERE customer_id NOT IN (SELECT master_id FROM resolved)",
        "fx_cards", "resolved",
    ),
    "stale_keys": _with("SELECT o_orderkey FROM stale", "stale"),
    "missing_keys": _with("SELECT o_orderkey FROM missing", "missing"),
    "key_parity": _with(
        """SELECT (SELECT count(DISTINCT o_orderkey) FROM fx_src_orders) AS source_keys,
            (SELECT count(DISTINCT o_orderkey) FROM fx_tgt_orders) AS target_keys,
            (SELECT count(*) FROM missing) AS missing, (SELECT count(*) FROM stale) AS stale,
            (SELECT count(*) - count(DISTINCT o_orderkey) FROM fx_tgt_orders) AS duplicates,
            (SELECT count(*) FROM fx_tgt_orders WHERE o_orderkey IS NULL) AS null_keys""",
        "missing", "stale",
    ),
    "key_parity_sample": _with("SELECT side, key_text FROM samples WHERE rn <= 5", "samples"),
    "duplicate_keys": _with(
        "SELECT count(*) - count(DISTINCT transaction_id) AS duplicates FROM fx_transactions", "fx_transactions"
    ),
    "null_keys": _with("SELECT count(*) AS null_keys FROM fx_customers WHERE government_id IS NULL", "fx_customers"),
    "constraint_violations": _with(
        """SELECT 'advances' AS dataset, 'status_in_enum' AS rule, count(*) AS violations FROM fx_advances
                WHERE amount_cents < 150000 OR status NOT IN ('requested', 'funded', 'paid_off', 'cancelled')
            UNION ALL SELECT 'advances', 'amount_not_negative', count(*) FROM fx_advances WHERE amount_cents < 0
            UNION ALL SELECT 'advances', 'customer_id_not_null', count(*) FROM fx_advances WHERE customer_id IS NULL
            UNION ALL SELECT 'cards', 'last_four_length', count(*) FROM fx_cards WHERE length(last_four) <> 4
            UNION ALL SELECT 'cards', 'token_not_null', count(*) FROM fx_cards WHERE status = 'inactive'
            UNION ALL SELECT 'cards', 'customer_id_not_null', count(*) FROM fx_cards WHERE customer_id IS NULL
            UNION ALL SELECT 'cards', 'token_unique', count(*) - count(DISTINCT last_four) FROM fx_cards
                WHERE status <> 'inactive'""",
        "fx_advances", "fx_cards",
    ),
    "monotonic_sequence": _with(
        """SELECT (SELECT count(*) FROM fx_history WHERE history_id <= -1) AS replayed,
            (SELECT count(*) FROM (SELECT changed_at, lag(changed_at) OVER (PARTITION BY advance_id ORDER BY history_id)
                AS before FROM fx_history) WHERE changed_at < before) AS decreases""",
        "fx_history",
    ),
    "order_breaks": _with(
        f"""SELECT count(*) AS decreases FROM (SELECT updated_at, lag(updated_at) OVER (PARTITION BY advance_id
            ORDER BY transaction_id) AS before FROM ({_LATEST})) WHERE updated_at < before""",
        "fx_transactions",
    ),
    "check_alias_coverage": _with(
        """SELECT (SELECT count(*) FROM fx_customers WHERE NOT is_test) AS customers,
            (SELECT count(*) FROM resolved) AS aliases""",
        "resolved",
    ),
    "check_test_data_excluded": _with("SELECT n AS leaked FROM leaked", "leaked"),
    "check_protected_survives": _with("SELECT n AS remapped FROM moved", "moved"),
    "check_identity_conflicts": _with(
        """SELECT count(DISTINCT proof_key) AS conflicts FROM resolved
            WHERE rule = 'protected_conflict' AND is_protected""",
        "resolved",
    ),
    "check_review_candidates": _with("SELECT CAST(count(*) AS VARCHAR) AS pairs FROM pairs", "pairs"),
    "malformed_contacts": _with(
        """SELECT count(*) FILTER (WHERE NOT ok_email) AS bad_emails, count(*) FILTER (WHERE NOT ok_phone) AS bad_phones
            FROM contacts""",
        "contacts",
    ),
    "dq_suite": _with("SELECT * FROM verdicts", "verdicts"),
    "dq_gate": _with(
        """SELECT count(*) FILTER (WHERE status = 'PASS') AS passed, count(*) FILTER (WHERE status = 'WARN') AS warned,
            count(*) FILTER (WHERE status = 'FAIL') AS failed, count(*) FILTER (WHERE status = 'FAIL') = 0 AS may_publish
            FROM verdicts""",
        "verdicts",
    ),
    "dq_status_summary": _with(
        """SELECT status, count(*) AS n FROM fx_dq_results WHERE run_id = (SELECT run_id FROM fx_dq_results
            ORDER BY checked_at DESC, run_id DESC LIMIT 1) GROUP BY status""",
        "fx_dq_results",
    ),
    "upsert_snapshot": _with(f"SELECT {_SNAPSHOT} FROM upserted", "upserted"),
    "reconciled_snapshot": _with(f"SELECT {_SNAPSHOT} FROM reconciled", "reconciled"),
    "published_state": _with(f"SELECT {_SNAPSHOT} FROM reconciled", "reconciled"),
    "apply_change_set": _with(
        f"""SELECT {_SNAPSHOT} FROM (
            SELECT * FROM fx_tgt_orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM fx_changes)
            UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, amount_cents, updated_at FROM fx_changes
                WHERE op IN ('I', 'U'))""",
        "fx_tgt_orders", "fx_changes",
    ),
    "replay_is_noop": _with(
        """SELECT (SELECT count(*) FROM fx_src_orders s, upper u WHERE s.updated_at > u.bound) AS extracted,
            (SELECT count(*) FROM reconciled WHERE o_orderkey NOT IN (SELECT o_orderkey FROM fx_src_orders)) AS stale,
            (SELECT count(*) FROM (SELECT * FROM reconciled EXCEPT SELECT * FROM reconciled
                WHERE o_orderkey IN (SELECT o_orderkey FROM fx_src_orders))) = 0 AS same_state""",
        "reconciled",
    ),
    "payload_bytes": _with(
        f"SELECT CAST(sum({_BYTES}) AS BIGINT) AS payload_bytes, count(*) AS row_count FROM delta", "delta"
    ),
    "sync_metrics": _with(
        f"""SELECT 'orders' AS table_name, metric_name, CAST(metric_value AS BIGINT) AS metric_value, unit FROM (
            SELECT 'rows_extracted' AS metric_name, count(*) AS metric_value, 'rows' AS unit FROM delta
            UNION ALL SELECT 'rows_upserted', count(*), 'rows' FROM delta
            UNION ALL SELECT 'rows_deleted', count(*), 'rows' FROM stale
            UNION ALL SELECT 'payload_bytes_estimated', sum({_BYTES}), 'bytes' FROM delta
            UNION ALL SELECT 'source_keys_scanned', count(*), 'keys' FROM fx_src_orders)""",
        "delta", "stale",
    ),
    "table_digest": _with(
        f"{_digest('source')} FROM fx_src_orders UNION ALL {_digest('reconciled')} FROM reconciled", "reconciled"
    ),
    "latest_runs": _with(
        """SELECT run_id, status, CAST(started_at AS VARCHAR) AS started_at, error_message FROM fx_runs
            ORDER BY fx_runs.started_at DESC, run_id LIMIT 5""",
        "fx_runs",
    ),
    "run_totals": _with(
        """SELECT run_id, CAST(sum(metric_value) AS BIGINT) AS total FROM fx_metrics
            WHERE metric_name = 'rows_extracted' GROUP BY run_id""",
        "fx_metrics",
    ),
    "current_watermarks": _with(
        f"""SELECT 'orders' AS source_table, 'updated_at' AS cursor_column, {_iso('max(updated_at)')} AS cursor_value
                FROM fx_src_orders
            UNION ALL SELECT 'transactions', 'updated_at', {_iso('max(updated_at)')} FROM fx_transactions
            UNION ALL SELECT 'advance_status_history', 'history_id', CAST(max(history_id) AS VARCHAR) FROM fx_history
            UNION ALL SELECT 'advance_changes', 'changed_at', {_iso('max(changed_at)')} FROM fx_history""",
        "fx_src_orders", "fx_transactions", "fx_history",
    ),
    "warehouse_counts": _with(
        """SELECT 'customers_raw' AS table_name, count(*) AS row_count FROM fx_customers
            UNION ALL SELECT 'advances_raw', count(*) FROM fx_advances
            UNION ALL SELECT 'transactions_raw', count(*) FROM fx_transactions
            UNION ALL SELECT 'cards_raw', count(*) FROM fx_cards
            UNION ALL SELECT 'advance_status_history_raw', count(*) FROM fx_history
            UNION ALL SELECT 'customer_alias', count(*) FROM resolved
            UNION ALL SELECT 'customer_master', count(DISTINCT master_id) FROM resolved
            UNION ALL SELECT 'identity_conflicts', count(*) FROM resolved WHERE rule = 'protected_conflict' AND is_protected
            UNION ALL SELECT 'identity_review_candidates', count(*) FROM pairs
            UNION ALL SELECT 'cards_master', count(*) FROM remapped""",
        "fx_transactions", "fx_history", "groups", "remapped",
    ),
    "dataset_metadata": _with(
        """SELECT dataset, owner, classification, contains_pii, retention_days, check_a || ',' || check_b AS dq_checks,
            metadata_version FROM (SELECT * FROM fx_metadata_stored WHERE dataset NOT IN
                (SELECT dataset FROM fx_metadata_declared) UNION ALL SELECT * FROM fx_metadata_declared)""",
        "fx_metadata_stored", "fx_metadata_declared",
    ),
}
