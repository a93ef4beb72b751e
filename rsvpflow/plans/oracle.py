"""DuckDB twins of the registered queries (the correctness oracle).

Written independently of the Spark code as plain SQL over the driver's views
(``orders``, ``customer``, ...).  Shared *parameters* (fixture SQL, region lists,
filter specs, date formats) are imported so both sides test the same thing.
"""

from __future__ import annotations

import re

from rsvpflow.functions.scalars import REGIONS
from rsvpflow.plans.fixtures import CHANGE_OFFSET, MASTER_SQL
from rsvpflow.plans.queries import BATCH_TS, CASCADE_SPEC, FILTER_ALL5, FILTER_SPEC
from rsvpflow.roles import ANALYSIS_FIELDS, DETAILS_FIELDS, ROLE_ORDER, ROLES, derived_name

MASTER = MASTER_SQL.format(orders="orders", customer="customer", nation="nation")
MASTER_COLUMNS = re.findall(r" AS (\w+),?\n", MASTER)

FLOAT_FULL = r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)\s*$"
FLOAT_PREFIX = r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"


# What Python's str.strip() removes and \\s matches, as code points and as an RE2 class.
_BLANK = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
_BLANKS = " || ".join(f"chr({n})" for n in _BLANK)
_BLANK_CLASS = "[" + "".join(f"\\x{{{n:x}}}" for n in _BLANK) + "]"


def STRIP(x):
    return f"trim({x}, {_BLANKS})"


def T(x):  # title case
    return (f"array_to_string(list_transform(regexp_extract_all({STRIP(x)}, '(\\p{{L}}+|[^\\p{{L}}]+)', 0), "
            f"lambda w: upper(left(w, 1)) || lower(substr(w, 2))), '')")


def LABEL(x):
    t = T(x)
    return f"(CASE WHEN regexp_matches({t}, '^[0-9]+{_BLANK_CLASS}+.+$') THEN regexp_extract({t}, '^[0-9]+{_BLANK_CLASS}+(.+)$', 1) ELSE {t} END)"


def WEIGHT(x):
    return f"coalesce(try_cast(nullif(regexp_extract({STRIP(x)}, '^([0-9]+){_BLANK_CLASS}+', 1), '') AS BIGINT), 1)"


def SI(x):
    return f"coalesce(try_cast(trunc(try_cast(nullif(regexp_extract({x}, '{FLOAT_FULL}', 1), '') AS DOUBLE)) AS BIGINT), 0)"


def NP(x):
    return (f"(CASE WHEN {x} IS NOT NULL THEN coalesce(try_cast(nullif(regexp_extract({x}, '{FLOAT_PREFIX}', 1), '') "
            f"AS DOUBLE), 0.0) END)")


def REGION(x):
    whens = " ".join("WHEN " + " OR ".join(f"contains(lower({STRIP(x)}), '{city.lower()}')" for city in c) + f" THEN '{n}'"
                     for n, c in REGIONS)
    return f"(CASE WHEN {x} IS NULL THEN 'Unknown' {whens} ELSE 'Other' END)"


def PDATE(x):
    fmts = ["%Y-%m-%d", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%S.%g", "%Y/%m/%d", "%m/%d/%Y", "%m-%d-%Y",
            "%d/%m/%Y", "%d-%m-%Y", "%d-%b-%Y", "%d %b %Y", "%b %d, %Y", "%Y%m%d"]
    return "CAST(coalesce(" + ", ".join(f"try_strptime({STRIP(x)}, '{f}')" for f in fmts) + ") AS DATE)"


def RATE(num, den):
    return f"(CASE WHEN {den} > 0 THEN round_even({num} / {den} * 100.0 * 100.0, 0) / 100.0 ELSE 0.0 END)"


def PRESENT(x):
    return f"({x} IS NOT NULL AND {x} <> '')"


def ESC(x):
    return (f"coalesce(replace(replace(replace(replace({STRIP(x)}, '\\', '\\\\'), ',', '\\,'), ';', '\\;'), "
            f"chr(10), '\\n'), '')")


def CARD(name, desig, client, phone, email):
    first = (f"(CASE WHEN {PRESENT(name)} OR {PRESENT(desig)} THEN concat_ws(' ', "
             f"CASE WHEN {PRESENT(name)} THEN {ESC(name)} END, "
             f"CASE WHEN {PRESENT(desig)} THEN '(' || {ESC(desig)} || ')' END) ELSE 'Unknown' END)")
    last = f"(CASE WHEN {PRESENT(client)} THEN {ESC(client)} ELSE 'Company' END)"
    return (f"concat_ws(chr(10), 'BEGIN:VCARD', 'VERSION:3.0', 'FN:' || {first} || ' ' || {last}, "
            f"'N:' || {last} || ';' || {first} || ';;;', "
            f"CASE WHEN {ESC(phone)} <> '' THEN 'TEL;TYPE=WORK,VOICE:' || {ESC(phone)} END, "
            f"CASE WHEN {ESC(email)} <> '' THEN 'EMAIL;TYPE=WORK:' || {ESC(email)} END, 'END:VCARD')")


def fan_sql(src):
    parts = []
    for r in ROLE_ORDER:
        s = ROLES[r]
        parts.append(
            f"SELECT '{r}' AS role, id, Client_Name AS client, Practice_Head, Partner, Sector, Response, numInvitees, "
            f"numRegistrations, Invite_Status, {s.name} AS name, {s.designation} AS designation, {s.email} AS email, "
            f"{s.phone} AS phone, {s.location} AS location, {s.response} AS contact_response FROM {src} "
            f"WHERE {PRESENT(s.phone)}")
    return " UNION ALL ".join(parts)


def changed_sql(src):
    """NEW image of every master row under the change feed (see fixtures.change_feed)."""
    return (f"SELECT * REPLACE ("
            f"CASE WHEN id % 10 = 1 THEN '+91-9' || CAST(id AS VARCHAR) WHEN id % 10 = 4 THEN '' ELSE Phone_Number END AS Phone_Number, "
            f"CASE WHEN id % 10 = 2 THEN coalesce(Phone_Number_4, '+44-8' || CAST(id AS VARCHAR)) ELSE Phone_Number_4 END AS Phone_Number_4, "
            f"CASE WHEN id % 10 = 5 THEN 'changed head' ELSE Practice_Head END AS Practice_Head, "
            f"CASE WHEN id % 10 = 5 THEN 'Registered' ELSE Response_1 END AS Response_1) FROM {src}")


SM = (f"SELECT * REPLACE ({T('Practice_Head')} AS Practice_Head, {T('Partner')} AS Partner, "
      f"{T('Client_Name')} AS Client_Name, {T('Location')} AS Location, {T('Sector')} AS Sector, "
      f"{LABEL('Response')} AS Response), {WEIGHT('Response')} AS Response_Weight FROM m")
SC = (f"SELECT * REPLACE (CASE WHEN role = 'tax' THEN {T('client')} ELSE client END AS client, "
      f"{T('Practice_Head')} AS Practice_Head, {T('Partner')} AS Partner, {T('Sector')} AS Sector, "
      f"CASE WHEN role = 'tax' THEN {T('location')} ELSE location END AS location, {LABEL('Response')} AS Response), "
      f"{WEIGHT('Response')} AS Response_Weight FROM c")

BASE = (f"WITH m AS MATERIALIZED ({MASTER}),\n sm AS ({SM}),\n c AS ({fan_sql('m')}),\n sc AS ({SC}),\n"
        f" u AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY role, phone ORDER BY id) = 1),\n"
        f" t AS (SELECT * REPLACE (CASE WHEN id % 4 = 0 THEN 'Old' ELSE Response END AS Response) FROM m WHERE id % 10 <> 3),\n"
        f" s AS (SELECT * FROM m WHERE id % 10 <> 7),\n"
        f" s_first AS (SELECT * FROM s WHERE Client_Name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY Client_Name ORDER BY id) = 1),\n"
        f" s_last AS (SELECT * FROM s WHERE Client_Name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY Client_Name ORDER BY id DESC) = 1),\n"
        f" m2 AS ({changed_sql('m')}),\n"
        f" fm AS (SELECT * FROM m2 WHERE id % 10 <> 6),\n"
        f" c2 AS ({fan_sql('fm')}),\n"
        f" cu AS ({fan_sql('(SELECT * FROM m2 WHERE id % 10 IN (1, 2, 4, 5))')}),\n"
        f" cd AS ({fan_sql('(SELECT * FROM m WHERE id % 10 = 6)')}),\n"
        f" uc AS (SELECT * FROM c WHERE client IS NULL UNION ALL SELECT * FROM c WHERE client IS NOT NULL "
        f"QUALIFY row_number() OVER (PARTITION BY role, phone, client ORDER BY id) = 1),\n"
        f" bp AS (SELECT * REPLACE ('stored' AS designation) FROM u WHERE id % 3 = 0 UNION ALL "
        f"SELECT * REPLACE ('stored' AS designation, phone || '#' AS phone) FROM u WHERE id % 5 = 1),\n"
        f" bpc AS (SELECT * REPLACE ('stored' AS designation) FROM uc WHERE id % 3 = 0 UNION ALL "
        f"SELECT * REPLACE ('stored' AS designation, phone || '#' AS phone) FROM uc WHERE id % 5 = 1),\n"
        f" elig AS (SELECT * FROM u WHERE {PRESENT('phone')} AND {NP('numRegistrations')} = 1 "
        f"AND contact_response IS NOT NULL AND {NP('contact_response')} >= 0)\n")


def q(body):
    return BASE + body


def in_list(vals):
    return ", ".join("'" + v.replace("'", "''") + "'" for v in vals)


def filt(spec, src="sm"):
    cols = {"ph": "Practice_Head", "partner": "Partner", "sector": "Sector", "loc": "Location", "resp": "Response"}
    conds = [f"{cols[k]} IN ({in_list(v)})" for k, v in spec.items() if v]
    return f"SELECT * FROM {src}" + (" WHERE " + " AND ".join(conds) if conds else "")


def cascade(src, fm):
    return (f"SELECT * FROM {src} WHERE Practice_Head IN (SELECT Practice_Head FROM ({fm}) WHERE Practice_Head IS NOT NULL) "
            f"AND Partner IN (SELECT Partner FROM ({fm}) WHERE Partner IS NOT NULL)")


def role_region(src):
    cl = f"lower({STRIP('contact_response')})"
    return (f"SELECT role, region, total_invited, registered, positive_responses, registered + positive_responses AS total_confirmed, "
            f"total_invited - (registered + positive_responses) AS unregistered, "
            f"round_even((registered + positive_responses) / total_invited * 100.0 * 100.0, 0) / 100.0 AS registration_rate FROM ("
            f"SELECT role, {REGION('location')} AS region, count(phone) AS total_invited, CAST(count_if({cl} = 'registered') AS BIGINT) AS registered, "
            f"CAST(count_if({cl} = 'positive') AS BIGINT) AS positive_responses FROM ({src}) WHERE location IS NOT NULL GROUP BY ALL) "
            f"WHERE registered + positive_responses > 0")


def owner_aggs():
    return (f"count(Client_Name) AS invites_sent, CAST(sum({SI('numInvitees')}) AS BIGINT) AS invitees, "
            f"CAST(sum({SI('numRegistrations')}) AS BIGINT) AS registrations, count(Response) AS responses")


def role_view_sql(role, kind):
    spec = ROLES[role]
    fields = ANALYSIS_FIELDS if kind == "analysis" else DETAILS_FIELDS
    return q(f"SELECT {', '.join(f'{f} AS {derived_name(spec, f)}' for f in fields)} FROM c WHERE role = '{role}'")


def profile_sql():
    parts = []
    for i, col in enumerate(MASTER_COLUMNS):
        if col == "id":
            parts.append(f"SELECT 'id' AS column_name, CAST({i} AS INTEGER) AS position, 'INT' AS sql_type, count(id) AS non_null, "
                         f"CAST(NULL AS BIGINT) AS max_len, CAST(NULL AS BIGINT) AS suggested_len FROM m")
        else:
            ml = f"CAST(max(length({col})) AS BIGINT)"
            parts.append(f"SELECT '{col}', CAST({i} AS INTEGER), 'VARCHAR', count({col}), {ml}, "
                         f"CASE WHEN {ml} IS NULL THEN 255 ELSE least(CAST(floor({ml} * 1.5) AS BIGINT) + 50, 1000) END FROM m")
    return q(" UNION ALL ".join(parts))


def actions_sql():
    diff = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in MASTER_COLUMNS)
    return q("SELECT action, count(*) AS row_count FROM ("
             f"SELECT CASE WHEN t.Client_Name IS NOT NULL AND s.Client_Name IS NOT NULL THEN "
             f"(CASE WHEN {diff} THEN 'updated' ELSE 'unchanged' END) "
             f"WHEN s.Client_Name IS NOT NULL THEN 'inserted' ELSE 'deleted' END AS action "
             f"FROM (SELECT * FROM t WHERE Client_Name IS NOT NULL) t FULL OUTER JOIN s_last s ON t.Client_Name = s.Client_Name "
             f"UNION ALL SELECT 'kept_null_key' FROM t WHERE Client_Name IS NULL "
             f"UNION ALL SELECT 'inserted' FROM s WHERE Client_Name IS NULL) GROUP BY action")


def update_sql(version):
    setcols = ["client", "Practice_Head", "Partner", "Sector", "Response", "numInvitees", "numRegistrations",
               "Invite_Status", "name", "designation", "email", "location", "contact_response"]
    if version == "v1":
        setcols.remove("client")
    allc = ["role", "id", "client", "Practice_Head", "Partner", "Sector", "Response", "numInvitees",
            "numRegistrations", "Invite_Status", "name", "designation", "email", "phone", "location", "contact_response"]
    sel = ", ".join(f"CASE WHEN ul.phone IS NOT NULL THEN ul.{c} ELSE b.{c} END AS {c}" if c in setcols else f"b.{c} AS {c}"
                    for c in allc)
    return with_extra("ul AS (SELECT * FROM cu QUALIFY row_number() OVER (PARTITION BY role, phone ORDER BY id DESC) = 1)",
                      f"SELECT {sel} FROM u b LEFT JOIN ul ON b.role = ul.role AND b.phone = ul.phone")


_CC = ["role", "id", "client", "Practice_Head", "Partner", "Sector", "Response", "numInvitees", "numRegistrations",
       "Invite_Status", "name", "designation", "email", "phone", "location", "contact_response"]
_PAYLOAD = [c for c in _CC if c not in ("role", "phone", "client")]


def pr_sql():
    """Per role and U change: OLD phone / client next to NEW phone."""
    return " UNION ALL ".join(
        f"SELECT m.id, '{r}' AS role, m.{ROLES[r].phone} AS o_phone, m.Client_Name AS o_client, "
        f"m2.{ROLES[r].phone} AS n_phone FROM m JOIN m2 ON m.id = m2.id WHERE m.id % 10 IN (1, 2, 4, 5)"
        for r in ROLE_ORDER)


def triggers_sql(strict):
    """Row triggers applied one by one per phone, written as segments between X events (see the reference's order)."""
    nulls = ", ".join(f"NULL AS {c}" for c in _PAYLOAD)
    pay = ", ".join(f"x.{c}" for c in _PAYLOAD)
    moved = "coalesce(pr.o_phone <> pr.n_phone, false)" if strict else "true"
    nn = " AND o_client IS NOT NULL" if strict else ""
    parts = [
        f"SELECT id + {CHANGE_OFFSET} AS seq, 0 AS ord, 'D' AS kind, role, o_phone AS phone, o_client AS client, "
        f"{nulls} FROM pr WHERE {PRESENT('o_phone')}{nn} AND (NOT {PRESENT('n_phone')} OR "
        f"{'coalesce(o_phone <> n_phone, false)' if strict else 'true'})",
        f"SELECT id + {CHANGE_OFFSET}, 0, 'D', role, phone, client, {nulls} FROM cd" + (" WHERE client IS NOT NULL" if strict else ""),
        f"SELECT x.id AS seq, 1, 'U', x.role, x.phone, x.client, {pay} FROM c x",
        f"SELECT x.id + {CHANGE_OFFSET}, 1, 'U', x.role, x.phone, x.client, {pay} FROM cu x "
        f"JOIN pr ON x.id = pr.id AND x.role = pr.role WHERE {moved}"]
    if strict:
        parts.append(f"SELECT x.id + {CHANGE_OFFSET}, 1, 'X', x.role, x.phone, x.client, {pay} FROM cu x "
                     f"JOIN pr ON x.id = pr.id AND x.role = pr.role WHERE NOT {moved}")
    ev = " UNION ALL ".join(parts)
    cols = ", ".join(_CC)
    if not strict:
        ctes = (f"pr AS ({pr_sql()}),\n ev AS ({ev}),\n fold AS (SELECT * FROM ev QUALIFY row_number() OVER "
                f"(PARTITION BY role, phone, client ORDER BY seq DESC, ord DESC) = 1)")
        return with_extra(ctes, f"SELECT {cols} FROM fold WHERE kind = 'U' UNION ALL SELECT {cols} FROM bpc b WHERE NOT EXISTS "
                          "(SELECT 1 FROM fold WHERE fold.role = b.role AND fold.phone = b.phone AND fold.client IS NOT DISTINCT FROM b.client)")
    ctes = (f"pr AS ({pr_sql()}),\n ev AS MATERIALIZED (SELECT *, sum(CASE WHEN kind = 'X' THEN 1 ELSE 0 END) OVER "
            f"(PARTITION BY role, phone ORDER BY seq, ord) AS seg FROM ({ev})),\n"
            " fin AS (SELECT role, phone, max(seg) AS s FROM ev GROUP BY ALL),\n"
            " fold AS MATERIALIZED (SELECT * FROM ev WHERE kind <> 'X' AND client IS NOT NULL QUALIFY row_number() OVER "
            "(PARTITION BY role, phone, seg, client ORDER BY seq DESC, ord DESC) = 1),\n"
            " ups AS (SELECT * FROM fold WHERE kind = 'U' UNION ALL SELECT * FROM ev WHERE kind = 'U' AND client IS NULL),\n"
            " st AS (SELECT * FROM bpc b WHERE NOT EXISTS (SELECT 1 FROM fold f WHERE f.seg = 0 AND f.role = b.role AND f.phone = b.phone AND f.client = b.client)),\n"
            " dec AS (SELECT role, phone, seg, 1 AS d FROM ups UNION ALL SELECT role, phone, 0, 1 FROM st UNION ALL "
            "SELECT x.role, x.phone, x.seg, 0 FROM ev x JOIN fold f ON x.kind = 'X' AND f.kind = 'D' AND x.role = f.role AND x.phone = f.phone "
            "AND x.seg = f.seg AND x.client = f.client),\n"
            " one AS (SELECT role, phone, seg, max(d) AS d FROM dec GROUP BY ALL),\n"
            " alive AS (SELECT one.role, one.phone FROM one JOIN fin ON one.role = fin.role AND one.phone = fin.phone WHERE seg < s "
            "GROUP BY ALL HAVING arg_max(d, seg) = 1)")
    c = lambda t: ", ".join(f"{t}.{x}" for x in _CC)
    return with_extra(ctes, f"SELECT {c('u')} FROM ups u JOIN fin ON u.role = fin.role AND u.phone = fin.phone AND u.seg = fin.s "
                      f"UNION ALL SELECT {c('x')} FROM ev x JOIN fin ON x.kind = 'X' AND x.role = fin.role AND x.phone = fin.phone AND x.seg = fin.s "
                      "JOIN alive a ON a.role = x.role AND a.phone = x.phone WHERE NOT EXISTS (SELECT 1 FROM fold f WHERE f.role = x.role "
                      "AND f.phone = x.phone AND f.seg = x.seg AND f.client = x.client) "
                      f"UNION ALL SELECT {c('b')} FROM st b WHERE NOT EXISTS (SELECT 1 FROM fin WHERE s > 0 AND fin.role = b.role AND fin.phone = b.phone)")


def keyed_triggers_sql(version):
    """v1 / v2 row triggers on UNIQUE(role, phone): the state of a phone behind its last delete, written with windows."""
    late = CHANGE_OFFSET + (CHANGE_OFFSET >> 1)
    at = "id" if version == "v1" else f"CASE WHEN id % 3 = 1 THEN id + {late} ELSE id END"
    gone = f" UNION ALL SELECT id + {CHANGE_OFFSET}, 'D', * FROM cd" if version == "v2" else ""
    cols = [c for c in _CC if c not in ("role", "phone", "id") and (version == "v2" or c != "client")]
    pick = lambda base: ", ".join(f"CASE WHEN n.seq IS NOT NULL THEN n.{c} ELSE {base}.{c} END AS {c}" if c in cols else f"{base}.{c} AS {c}" for c in _CC)
    on = lambda a, b: f"{a}.role = {b}.role AND {a}.phone = {b}.phone"
    return with_extra(
        f"ev AS MATERIALIZED (SELECT {at} AS seq, 'I' AS op, * FROM c UNION ALL SELECT id + {CHANGE_OFFSET}, 'U', * FROM cu{gone}),\n"
        " dl AS (SELECT role, phone, max(seq) AS seq FROM ev WHERE op = 'D' GROUP BY ALL),\n"
        f" fi AS (SELECT e.* FROM ev e LEFT JOIN dl ON {on('e', 'dl')} WHERE e.op = 'I' AND (dl.seq IS NULL OR e.seq > dl.seq) "
        "QUALIFY row_number() OVER (PARTITION BY e.role, e.phone ORDER BY e.seq) = 1),\n"
        " lu AS (SELECT * FROM ev WHERE op = 'U' QUALIFY row_number() OVER (PARTITION BY role, phone ORDER BY seq DESC) = 1)",
        f"SELECT {pick('b')} FROM bp b LEFT JOIN lu n ON {on('b', 'n')} WHERE NOT EXISTS (SELECT 1 FROM dl WHERE {on('dl', 'b')}) UNION ALL "
        f"SELECT {pick('f')} FROM fi f LEFT JOIN lu n ON {on('f', 'n')} AND n.seq > f.seq "
        f"WHERE NOT EXISTS (SELECT 1 FROM bp b WHERE {on('b', 'f')}) OR EXISTS (SELECT 1 FROM dl WHERE {on('dl', 'f')})")


def with_extra(ctes, body):
    return BASE.rstrip("\n") + ",\n " + ctes + "\n" + body


def dup_sql():
    return ("SELECT role, phone, count(*) AS dup_count, count(client || ' (' || name || ')') AS labelled "
            "FROM c WHERE phone IS NOT NULL AND phone <> '' GROUP BY role, phone HAVING count(*) > 1")


DUP_TOP = with_extra(
    f"d AS ({dup_sql()}),\n"
    " top AS (SELECT *, CAST(row_number() OVER (PARTITION BY role ORDER BY dup_count DESC, phone) AS INTEGER) AS phone_rank FROM d QUALIFY phone_rank <= 20),\n"
    " p AS (SELECT c.role, c.phone, c.client || ' (' || c.name || ')' AS person FROM c SEMI JOIN top ON c.role = top.role AND c.phone = top.phone WHERE c.client IS NOT NULL AND c.name IS NOT NULL),\n"
    " pr AS (SELECT *, CAST(row_number() OVER (PARTITION BY role, phone ORDER BY person) AS INTEGER) AS person_rank FROM p QUALIFY person_rank <= 3)",
    "SELECT top.role, phone_rank, top.phone, dup_count, pr.person_rank, pr.person, CAST(greatest(labelled - 3, 0) AS BIGINT) AS more "
    "FROM top LEFT JOIN pr ON pr.role = top.role AND pr.phone = top.phone")


def reconcile_sql(cond=""):
    w = f" WHERE {cond}" if cond else ""
    per = (f"SELECT coalesce(a.role, b.role) AS role, coalesce(a.n, 0) AS master_n, coalesce(b.n, 0) AS derived_n, "
             f"coalesce(a.n, 0) - coalesce(b.n, 0) AS missing, coalesce(a.n, 0) = coalesce(b.n, 0) AS in_sync FROM "
             f"(SELECT role, count(*) AS n FROM c{w} GROUP BY role) a FULL OUTER JOIN "
           f"(SELECT role, count(*) AS n FROM u{w} GROUP BY role) b ON a.role = b.role")
    return with_extra(f"rec AS ({per})", "SELECT * FROM rec UNION ALL SELECT 'total', CAST(coalesce(sum(master_n), 0) AS BIGINT), "
                      "CAST(coalesce(sum(derived_n), 0) AS BIGINT), CAST(coalesce(sum(missing), 0) AS BIGINT), "
                      "coalesce(sum(master_n), 0) = coalesce(sum(derived_n), 0) FROM rec")


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

_TS = f"CAST('{BATCH_TS}' AS TIMESTAMP)"
_RESP = "(Response IS NOT NULL AND lower(Response) <> 'awaited')"
_SUM_REG = f"sum({SI('numRegistrations')})"
_SUM_INV = f"sum({SI('numInvitees')})"
_CARD = CARD("name", "designation", "client", "phone", "email")

_OVERVIEW = q(f"SELECT count(*) AS total_clients, CAST(sum({SI('numInvitees')}) AS BIGINT) AS total_invitees, "
              f"CAST(sum({SI('numRegistrations')}) AS BIGINT) AS registrations, "
              f"{RATE(f'count_if({_RESP})', 'count(*)')} AS response_rate FROM sm")
_RESPONSE_WEIGHTS = q("SELECT Response AS response, CAST(sum(Response_Weight) AS BIGINT) AS weight FROM sm "
                      "WHERE Response IS NOT NULL GROUP BY Response")

def long_sql(parts):
    """Reports (name, keys, metrics, sql) as rows (report, k1, k2, metric, value)."""
    out = []
    for name, keys, values, sql in parts:
        k1, k2 = [f"CAST({k} AS VARCHAR)" for k in keys] + ["CAST(NULL AS VARCHAR)"] * (2 - len(keys))
        out += [f"SELECT '{name}' AS report, {k1} AS k1, {k2} AS k2, '{v}' AS metric, CAST({v} AS DOUBLE) AS value FROM ({sql})" for v in values]
    return " UNION ALL ".join(out)


def kpi_parts(sm, sc):
    """A1, A2, A9, A9b and A10 over a standardised master and its contacts."""
    return [
        ("overview", [], ["total_clients", "total_invitees", "registrations", "response_rate"],
         f"SELECT count(*) AS total_clients, sum({SI('numInvitees')}) AS total_invitees, sum({SI('numRegistrations')}) AS registrations, "
         f"{RATE(f'count_if({_RESP})', 'count(*)')} AS response_rate FROM ({sm})"),
        ("response_weights", ["response"], ["weight"],
         f"SELECT Response AS response, sum(Response_Weight) AS weight FROM ({sm}) WHERE Response IS NOT NULL GROUP BY Response"),
        ("role_kpis", ["role"], ["total", "registered", "response_rate"],
         f"SELECT role, count(*) AS total, count_if(lower(contact_response) = 'registered') AS registered, {RATE(f'count_if({_RESP})', 'count(*)')} AS response_rate "
         f"FROM ({sc}) GROUP BY role"),
        ("role_region", ["role", "region"], ["total_invited", "registered", "positive_responses", "total_confirmed", "unregistered", "registration_rate"],
         role_region(sc)),
    ]


def _collated(body):
    """The pair with names in capitals and accents; ``fold`` is what the collation compares by."""
    import re as _re

    body = _re.sub(r"fold\(([^)]*)\)", r"strip_accents(lower(\1))", body)
    return with_extra(
        "tx AS (SELECT * REPLACE (CASE id % 3 WHEN 0 THEN upper(Client_Name) WHEN 1 THEN replace(replace(Client_Name, 'o', 'ö'), 'e', 'é') ELSE Client_Name END AS Client_Name) FROM t),\n"
        " sx AS (SELECT * FROM s UNION ALL SELECT * REPLACE (replace(upper(Client_Name), 'E', 'Ê') AS Client_Name, id + 1000000000000 AS id, 'again' AS Sector) FROM s WHERE id % 5 = 0),\n"
        " sl AS (SELECT * FROM sx WHERE Client_Name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY strip_accents(lower(Client_Name)) ORDER BY id DESC) = 1),\n"
        " sf AS (SELECT * FROM sx WHERE Client_Name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY strip_accents(lower(Client_Name)) ORDER BY id) = 1)", body)


_FSM = filt(FILTER_SPEC)
_FSC = cascade("sc", _FSM)
_EVENT_TIME = "(TIMESTAMP '2025-01-01 00:00:00' + to_days({day}) + to_seconds(CAST({id} % 86400 AS INTEGER)))"
_FIRST, _LATER = (_EVENT_TIME.format(day=d, id="x.id") for d in (0, 31))

ORACLE_SQL: dict[str, str] = {
    "dates_forms": "SELECT id, CASE WHEN k >= 12 THEN NULL WHEN k = 11 AND day(d) <= 12 THEN make_date(year(d), day(d), month(d)) ELSE d END AS read "
                   "FROM (SELECT o_orderkey AS id, o_orderkey % 14 AS k, CAST(o_orderdate AS DATE) AS d FROM orders)",
    "dates_inferred": with_extra(
        "v AS (SELECT id, regexp_extract(trim(Invite_Dt), '^([0-9]{1,2})-([0-9]{1,2})-[0-9]{4}$', ['a', 'b']) AS f, trim(Invite_Dt) AS t FROM m),\n"
        " o AS (SELECT count_if(try_cast(f.b AS INT) BETWEEN 1 AND 12 AND try_cast(f.a AS INT) BETWEEN 1 AND 31) > "
        "count_if(try_cast(f.a AS INT) BETWEEN 1 AND 12 AND try_cast(f.b AS INT) BETWEEN 1 AND 31) AS day_first FROM v)",
        f"SELECT v.id, CASE WHEN f.a <> '' THEN CAST(CASE WHEN (SELECT day_first FROM o) THEN try_strptime(t, '%d-%m-%Y') ELSE try_strptime(t, '%m-%d-%Y') END AS DATE) "
        f"ELSE {PDATE('t')} END AS invite_date, CAST(o_orderdate AS DATE) AS d1, CAST(o_orderdate AS DATE) AS d2 FROM v JOIN orders ON o_orderkey = v.id"),
    "reconcile_bags": with_extra(
        "g AS (SELECT * REPLACE (CASE WHEN id % 77 = 0 THEN name || '?' ELSE name END AS name) FROM c WHERE id % 91 <> 0),\n"
        " b AS (SELECT *, 1 AS e, 0 AS d FROM c UNION ALL SELECT *, 0, 1 FROM g UNION ALL SELECT *, 0, 1 FROM g WHERE id % 50 = 0 "
        "UNION ALL SELECT * REPLACE ('+0' AS phone), 0, 1 FROM c WHERE id % 83 = 0)",
        f"SELECT {', '.join(_CC)}, CAST(sum(e) AS BIGINT) AS n_expected, CAST(sum(d) AS BIGINT) AS n_derived, CASE WHEN sum(d) = 0 THEN 'missing_in_derived' "
        f"WHEN sum(e) = 0 THEN 'extra_in_derived' ELSE 'copies' END AS side FROM b GROUP BY {', '.join(_CC)} HAVING sum(e) <> sum(d)"),
    "replicate_changed": q("SELECT * EXCLUDE (id) FROM m2"),
    "upsert_collated": _collated(
        "SELECT l.* REPLACE (coalesce(x.Client_Name, l.Client_Name) AS Client_Name) FROM sl l LEFT JOIN tx x ON fold(x.Client_Name) = fold(l.Client_Name) "
        "UNION ALL SELECT * FROM tx WHERE Client_Name IS NOT NULL AND fold(Client_Name) NOT IN (SELECT fold(Client_Name) FROM sl) "
        "UNION ALL SELECT * FROM tx WHERE Client_Name IS NULL UNION ALL SELECT * FROM sx WHERE Client_Name IS NULL"),
    "insert_collated": _collated(
        "SELECT * FROM tx UNION ALL SELECT * FROM sf WHERE fold(Client_Name) NOT IN (SELECT fold(Client_Name) FROM tx WHERE Client_Name IS NOT NULL) "
        "UNION ALL SELECT * FROM sx WHERE Client_Name IS NULL"),
    "deleted_keys_collated": _collated(
        "SELECT DISTINCT Client_Name FROM tx WHERE Client_Name IS NOT NULL AND fold(Client_Name) NOT IN (SELECT fold(Client_Name) FROM sl)"),
    "regions_dictionary": with_extra(
        "pl AS (SELECT * FROM (VALUES " + ", ".join(f"('{city.lower()}', '{n}', {k}::BIGINT)" for k, (n, cities) in enumerate(REGIONS) for city in cities) +
        ") v(name, label, rank) UNION ALL SELECT lower(c_name), 'C' || CAST(c_nationkey % 7 AS VARCHAR), c_custkey + 1000000 FROM customer UNION ALL "
        "SELECT lower(left(c_name, length(c_name) - 1)), 'C' || CAST(c_nationkey % 7 AS VARCHAR) || 's', c_custkey * 3000000 % 2000003 FROM customer),\n"
        f" tx AS (SELECT DISTINCT lower({STRIP('x')}) AS t FROM (SELECT Location AS x FROM m UNION ALL SELECT Client_Name FROM m) WHERE x IS NOT NULL),\n"
        " lb AS MATERIALIZED (SELECT t, arg_min(label, (rank, label)) AS label FROM tx JOIN pl ON contains(t, name) GROUP BY t)",
        f"SELECT id, CASE WHEN Location IS NULL THEN 'Unknown' ELSE coalesce(a.label, 'Other') END AS r_place, "
        f"CASE WHEN Client_Name IS NULL THEN 'Unknown' ELSE coalesce(b.label, 'Other') END AS r_client FROM m "
        f"LEFT JOIN lb a ON a.t = lower({STRIP('Location')}) LEFT JOIN lb b ON b.t = lower({STRIP('Client_Name')})"),
    "csv_quarantine": """WITH o AS (SELECT o_orderkey AS i, CAST(o_custkey AS VARCHAR) AS cust, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS p FROM orders),
 r AS (SELECT i, cust, (CASE WHEN i % 23 = 0 THEN '' ELSE CAST(i AS VARCHAR) END) || ',' || cust || ',' || CASE WHEN i % 13 = 0 THEN 'abc' WHEN i % 19 = 0 THEN '-' || p ELSE p END AS line FROM o),
 l AS (SELECT i, CASE WHEN i % 17 = 0 THEN line || ',more' WHEN i % 29 = 0 THEN cust ELSE line END AS record FROM r)
SELECT record, CASE WHEN i % 13 = 0 OR i % 17 = 0 OR i % 29 = 0 THEN 'malformed' WHEN i % 23 = 0 THEN 'no key' WHEN i % 19 = 0 THEN 'negative price' ELSE 'good' END AS reason FROM l""",
    "apply_triggers_v1": keyed_triggers_sql("v1"),
    "apply_triggers_v2": keyed_triggers_sql("v2"),
    # the three renames of a row run at 1, 2, 3 (and 9); its first name is its own, so each row's names end by its id alone
    "cascade_rename_chain": q("SELECT c.* REPLACE (CASE WHEN client IS NULL THEN client WHEN id % 4 = 0 THEN client || '~' WHEN id % 4 = 1 THEN upper(client) "
                              "WHEN id % 4 = 2 THEN client ELSE client END AS client) FROM c"),
    "stream_changes_audit": with_extra(
        "x AS (SELECT c2.*, c.id IS NULL AS fresh, c.id IS NULL OR " + " OR ".join(f"c.{k} IS DISTINCT FROM c2.{k}" for k in _CC) + " AS moved "
        "FROM c2 LEFT JOIN c ON c.role = c2.role AND c.id = c2.id)",
        f"SELECT {', '.join(_CC)}, CASE WHEN fresh THEN {_LATER} ELSE {_FIRST} END AS Data_Insert_Time, "
        f"CASE WHEN moved THEN {_LATER} ELSE {_FIRST} END AS Last_Updated FROM x"),
    "stream_change_counts": with_extra(
        "k(action) AS (VALUES ('inserted'), ('updated'), ('unchanged'), ('deleted')),\n r(role) AS (VALUES ('tax'), ('cfo'), ('other')),\n"
        " cc AS (SELECT * FROM c WHERE id % 10 IN (1, 2, 4, 5)),\n"
        " e AS (SELECT role, 'inserted' AS action FROM c UNION ALL SELECT coalesce(a.role, b.role), CASE WHEN a.id IS NULL THEN 'inserted' WHEN b.id IS NULL "
        "THEN 'deleted' WHEN " + " OR ".join(f"a.{k} IS DISTINCT FROM b.{k}" for k in _CC) + " THEN 'updated' ELSE 'unchanged' END "
        "FROM cc a FULL JOIN cu b ON a.role = b.role AND a.id = b.id UNION ALL SELECT role, 'deleted' FROM cd)",
        "SELECT r.role, k.action, count(e.role) AS row_count FROM r CROSS JOIN k LEFT JOIN e ON e.role = r.role AND e.action = k.action GROUP BY ALL"),
    "stream_reports_on_changes": with_extra(
        f"fsm AS ({SM.replace('FROM m', 'FROM fm')}),\n fsc AS ({SC.replace('FROM c', 'FROM c2')})",
        long_sql([*kpi_parts("SELECT * FROM fsm", "SELECT * FROM fsc"),
                  ("role_responses", ["role", "response"], ["weight"],
                   "SELECT role, Response AS response, sum(Response_Weight) AS weight FROM fsc WHERE Response IS NOT NULL GROUP BY ALL")])),
    "reports_from_grain": with_extra(
        f"xm AS MATERIALIZED ({_FSM}),\n xc AS MATERIALIZED ({_FSC})",
        long_sql([*kpi_parts("SELECT * FROM xm", "SELECT * FROM xc"),
                  ("sector_perf", ["sector"], ["invitees", "registrations", "conversion"],
                   f"SELECT Sector AS sector, sum({SI('numInvitees')}) AS invitees, sum({SI('numRegistrations')}) AS registrations, "
                   f"{RATE(_SUM_REG, _SUM_INV)} AS conversion FROM xm WHERE Sector IS NOT NULL GROUP BY Sector"),
                  ("region_counts", ["region"], ["row_count"],
                   f"SELECT {REGION('Location')} AS region, count(*) AS row_count FROM xm WHERE Location IS NOT NULL GROUP BY 1"),
                  ("owner_stats_head", ["owner"], ["invites_sent", "invitees", "registrations", "responses"],
                   f"SELECT Practice_Head AS owner, {owner_aggs()} FROM xm WHERE Practice_Head IS NOT NULL GROUP BY 1"),
                  ("owner_totals", ["owner_type"], ["invites_sent", "invitees", "registrations", "responses"],
                   f"SELECT 'Practice_Head' AS owner_type, {owner_aggs()} FROM xm WHERE Practice_Head IS NOT NULL "
                   f"UNION ALL SELECT 'Partner', {owner_aggs()} FROM xm WHERE Partner IS NOT NULL"),
                  ("cfo_sectors", ["sector"], ["row_count"],
                   "SELECT Sector AS sector, count(*) AS row_count FROM xc WHERE role = 'cfo' AND Sector IS NOT NULL GROUP BY 1"),
                  ("metrics", [], ["conversion_rate", "response_rate", "pending_followups", "circle_backs"],
                   f"SELECT {RATE(_SUM_REG, _SUM_INV)} AS conversion_rate, {RATE('count(Response)', 'count(*)')} AS response_rate, "
                   "count_if(Response IS NULL) AS pending_followups, count(Circle_Back_Dt) AS circle_backs FROM xm"),
                  ("invite_trend", ["invite_date"], ["invites"],
                   f"SELECT {PDATE('Invite_Dt')} AS invite_date, count(*) AS invites FROM xm WHERE {PDATE('Invite_Dt')} IS NOT NULL GROUP BY 1")])),
    "column_profile": profile_sql(),
    "schema_evolve": "SELECT c_custkey, c_name, c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, "
                     "CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer",
    "table_inventory": " UNION ALL ".join([f"SELECT '{t}' AS table_name, true AS present, count(*) AS row_count FROM {t}"
                                           for t in TABLES] + ["SELECT 'master_archive', false, CAST(NULL AS BIGINT)"]),
    "common_columns": q("SELECT Client_Name, Practice_Head, Partner, Sector, Location, Invite_Status, numInvitees, "
                        "numRegistrations, Response, Tax_Contact, Designation, Email_ID, Phone_Number, Response_1 "
                        f"FROM m WHERE {PRESENT('Phone_Number')}"),
    "master_count": q("SELECT 'master' AS table_name, count(*) AS row_count FROM m"),
    "clean_headers": "SELECT l_returnflag AS Return_Flag, l_linestatus AS num_Status, "
                     "count(CASE WHEN l_discount > 0.09 THEN NULL ELSE l_tax END) AS n_tax, "
                     "round(sum(CASE WHEN l_discount > 0.09 THEN NULL ELSE l_tax END), 4) AS sum_tax, "
                     "round(sum(l_quantity), 4) AS sum_qty FROM lineitem GROUP BY ALL",
    "csv_roundtrip": q("SELECT * FROM m"),
    "load_and_sync": q("SELECT * FROM s_last UNION ALL SELECT * REPLACE (CAST(NULL AS VARCHAR) AS Sector) FROM t "
                       "WHERE Client_Name IS NULL UNION ALL SELECT * FROM s WHERE Client_Name IS NULL"),
    "load_and_sync_counts": q("SELECT action, count(*) AS row_count FROM ("
                              "SELECT CASE WHEN t.Client_Name IS NOT NULL AND s.Client_Name IS NOT NULL THEN "
                              "(CASE WHEN " + " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in MASTER_COLUMNS) +
                              " THEN 'updated' ELSE 'unchanged' END) WHEN s.Client_Name IS NOT NULL THEN 'inserted' "
                              "ELSE 'kept' END AS action FROM (SELECT * FROM t WHERE Client_Name IS NOT NULL) t "
                              "FULL OUTER JOIN s_last s ON t.Client_Name = s.Client_Name "
                              "UNION ALL SELECT 'kept_null_key' FROM t WHERE Client_Name IS NULL "
                              "UNION ALL SELECT 'inserted' FROM s WHERE Client_Name IS NULL) GROUP BY action"),
    "load_and_sync_insert_counts": with_extra(
        "i AS (SELECT Client_Name FROM s_first WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.Client_Name = s_first.Client_Name) "
        "UNION ALL SELECT Client_Name FROM s WHERE Client_Name IS NULL)",
        "SELECT 'inserted' AS action, (SELECT count(*) FROM i) AS row_count UNION ALL "
        "SELECT 'ignored', (SELECT count(*) FROM s) - (SELECT count(*) FROM i)"),
    "replica_status": q("SELECT 'master' AS table_name, 'ok' AS status, count(*) AS source_rows, count(*) AS copied_rows FROM m"),
    "deleted_keys_preview": q("SELECT DISTINCT Client_Name FROM t WHERE Client_Name IS NOT NULL AND NOT EXISTS "
                              "(SELECT 1 FROM s WHERE s.Client_Name = t.Client_Name) ORDER BY Client_Name LIMIT 10"),
    "contacts_long": q("SELECT * FROM c"),
    **{f"analysis_{r}": role_view_sql(r, "analysis") for r in ROLE_ORDER},
    **{f"details_{r}": role_view_sql(r, "details") for r in ROLE_ORDER},
    "filter_all5": q(filt(FILTER_ALL5)),
    "cascade_filter": q(cascade("sc", filt(CASCADE_SPEC))),
    "deleted_keys": q("SELECT DISTINCT Client_Name FROM t WHERE Client_Name IS NOT NULL AND NOT EXISTS "
                      "(SELECT 1 FROM s WHERE s.Client_Name = t.Client_Name)"),
    "orphans": "SELECT o.* FROM orders o WHERE o.o_custkey IS NOT NULL AND NOT EXISTS "
               "(SELECT 1 FROM customer k WHERE k.c_custkey % 10 <> 0 AND k.c_custkey = o.o_custkey)",
    "cascade_delete": q("SELECT * FROM c WHERE client IN (SELECT Client_Name FROM m WHERE id % 10 <> 7 AND Client_Name IS NOT NULL)"),
    "cascade_rename": q("SELECT c.* REPLACE (CASE WHEN r.old_key IS NOT NULL THEN r.new_key ELSE c.client END AS client) "
                        "FROM c LEFT JOIN (SELECT DISTINCT Client_Name AS old_key, upper(Client_Name) AS new_key FROM m WHERE id % 4 = 1) r "
                        "ON c.client = r.old_key"),
    "insert_new_only": q("SELECT * FROM t UNION ALL SELECT * FROM s_first WHERE NOT EXISTS "
                         "(SELECT 1 FROM t WHERE t.Client_Name = s_first.Client_Name) "
                         "UNION ALL SELECT * FROM s WHERE Client_Name IS NULL"),
    "upsert": q("SELECT * FROM s_last UNION ALL SELECT * FROM t WHERE Client_Name IS NOT NULL AND NOT EXISTS "
                "(SELECT 1 FROM s_last WHERE s_last.Client_Name = t.Client_Name) "
                "UNION ALL SELECT * FROM t WHERE Client_Name IS NULL UNION ALL SELECT * FROM s WHERE Client_Name IS NULL"),
    "smart_sync": q("SELECT * FROM s_last UNION ALL SELECT * FROM t WHERE Client_Name IS NULL "
                    "UNION ALL SELECT * FROM s WHERE Client_Name IS NULL"),
    "sync_action_counts": actions_sql(),
    "upsert_phone": with_extra(
        f"tp AS (SELECT id, Client_Name, Tax_Contact, Phone_Number, Response_1 FROM t WHERE {PRESENT('Phone_Number')} "
        "QUALIFY row_number() OVER (PARTITION BY Phone_Number ORDER BY id) = 1),\n"
        f" sp AS (SELECT id, Client_Name, Tax_Contact, Phone_Number, Response_1 FROM s WHERE {PRESENT('Phone_Number')} "
        "QUALIFY row_number() OVER (PARTITION BY Phone_Number ORDER BY id DESC) = 1)",
        "SELECT * FROM sp UNION ALL SELECT * FROM tp WHERE NOT EXISTS (SELECT 1 FROM sp WHERE sp.Phone_Number = tp.Phone_Number)"),
    "sync_audit": with_extra(
        "ta AS (SELECT id, Client_Name, Response, Sector, CAST('2024-06-01 00:00:00' AS TIMESTAMP) AS Data_Insert_Time, "
        "CAST('2024-06-01 00:00:00' AS TIMESTAMP) AS Last_Updated FROM t)",
        f"SELECT s.id, s.Client_Name, s.Response, s.Sector, coalesce(ta.Data_Insert_Time, {_TS}) AS Data_Insert_Time, "
        f"CASE WHEN ta.Client_Name IS NULL THEN {_TS} WHEN ta.id IS DISTINCT FROM s.id OR ta.Response IS DISTINCT FROM s.Response "
        f"OR ta.Sector IS DISTINCT FROM s.Sector THEN {_TS} ELSE ta.Last_Updated END AS Last_Updated "
        "FROM s_last s LEFT JOIN ta ON s.Client_Name = ta.Client_Name "
        "UNION ALL SELECT * FROM ta WHERE Client_Name IS NULL "
        f"UNION ALL SELECT id, Client_Name, Response, Sector, {_TS}, {_TS} FROM s WHERE Client_Name IS NULL"),
    "unique_phone": q("SELECT * FROM u"),
    "unique_phone_client": q("SELECT * FROM c WHERE client IS NOT NULL QUALIFY row_number() OVER "
                             "(PARTITION BY role, phone, client ORDER BY id DESC) = 1 UNION ALL SELECT * FROM c WHERE client IS NULL"),
    "rebuild_contacts": q("SELECT * FROM c2"),
    "apply_changes": q("SELECT * FROM c2"),
    "apply_insert_keep_first": with_extra(
        "n AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY role, phone ORDER BY id) = 1)",
        "SELECT * FROM bp UNION ALL SELECT * FROM n WHERE NOT EXISTS (SELECT 1 FROM bp WHERE bp.role = n.role AND bp.phone = n.phone)"),
    "apply_insert_keep_last": with_extra(
        "n AS (SELECT * FROM c WHERE client IS NOT NULL QUALIFY row_number() OVER (PARTITION BY role, phone, client ORDER BY id DESC) = 1)",
        "SELECT * FROM n UNION ALL SELECT * FROM c WHERE client IS NULL UNION ALL SELECT * FROM bpc b WHERE NOT EXISTS "
        "(SELECT 1 FROM n WHERE n.role = b.role AND n.phone = b.phone AND n.client = b.client)"),
    "apply_insert_keep_client": with_extra(
        "l AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY role, phone ORDER BY id DESC) = 1),\n"
        " f AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY role, phone ORDER BY id) = 1)",
        "SELECT l.* REPLACE (CASE WHEN bp.phone IS NOT NULL THEN bp.client ELSE f.client END AS client) FROM l "
        "JOIN f ON l.role = f.role AND l.phone = f.phone LEFT JOIN bp ON l.role = bp.role AND l.phone = bp.phone "
        "UNION ALL SELECT * FROM bp WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.role = bp.role AND l.phone = bp.phone)"),
    "apply_changes_out_of_order": q("SELECT * FROM c2"),
    "apply_update_v1": update_sql("v1"),
    "apply_update_v2": update_sql("v2"),
    "apply_triggers": triggers_sql(False),
    "apply_triggers_strict": triggers_sql(True),
    "apply_delete": q("SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM cd WHERE cd.role = c.role AND cd.phone = c.phone "
                      "AND cd.client IS NOT DISTINCT FROM c.client)"),
    "apply_delete_phone": q("SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM cd WHERE cd.role = c.role AND cd.phone = c.phone)"),
    "overview": q(f"SELECT count(*) AS total_clients, CAST(sum({SI('numInvitees')}) AS BIGINT) AS total_invitees, "
                  f"CAST(sum({SI('numRegistrations')}) AS BIGINT) AS registrations, "
                  f"{RATE(f'count_if({_RESP})', 'count(*)')} AS response_rate FROM sm"),
    "response_weights": q("SELECT Response AS response, CAST(sum(Response_Weight) AS BIGINT) AS weight FROM sm "
                          "WHERE Response IS NOT NULL GROUP BY Response"),
    "sector_perf": q(f"SELECT Sector AS sector, CAST(sum({SI('numInvitees')}) AS BIGINT) AS invitees, "
                     f"CAST(sum({SI('numRegistrations')}) AS BIGINT) AS registrations, "
                     f"{RATE(_SUM_REG, _SUM_INV)} AS conversion FROM sm WHERE Sector IS NOT NULL GROUP BY Sector"),
    "region_counts": q(f"SELECT {REGION('Location')} AS region, count(*) AS row_count FROM sm WHERE Location IS NOT NULL GROUP BY 1"),
    "owner_stats_head": q(f"SELECT Practice_Head AS owner, {owner_aggs()} FROM sm WHERE Practice_Head IS NOT NULL GROUP BY 1"),
    "owner_stats_partner": q(f"SELECT Partner AS owner, {owner_aggs()} FROM sm WHERE Partner IS NOT NULL GROUP BY 1"),
    "owner_totals": q(f"SELECT 'Practice_Head' AS owner_type, {owner_aggs()} FROM sm WHERE Practice_Head IS NOT NULL "
                      f"UNION ALL SELECT 'Partner' AS owner_type, {owner_aggs()} FROM sm WHERE Partner IS NOT NULL"),
    "owner_response": with_extra(
        "x AS (SELECT 'master' AS source, Practice_Head, Partner, Response, Response_Weight FROM sm UNION ALL "
        f"SELECT role AS source, Practice_Head, Partner, Response, Response_Weight FROM ({cascade('sc', 'SELECT * FROM sm')})),\n"
        " y AS (SELECT source, 'Practice_Head' AS owner_type, Practice_Head AS owner, Response, Response_Weight FROM x "
        "UNION ALL SELECT source, 'Partner' AS owner_type, Partner AS owner, Response, Response_Weight FROM x)",
        "SELECT source, owner_type, owner, Response AS response, CAST(sum(Response_Weight) AS BIGINT) AS weight FROM y "
        "WHERE owner IS NOT NULL AND Response IS NOT NULL GROUP BY ALL"),
    "owner_cross": q("SELECT pair, k1, k2, count(*) AS row_count FROM ("
                     "SELECT 'head_sector' AS pair, Practice_Head AS k1, Sector AS k2 FROM sm UNION ALL "
                     "SELECT 'head_location', Practice_Head, Location FROM sm UNION ALL "
                     "SELECT 'partner_location', Partner, Location FROM sm) WHERE k1 IS NOT NULL AND k2 IS NOT NULL GROUP BY ALL"),
    "owner_sector_rollup": q("SELECT CASE grouping(Practice_Head, Sector) WHEN 0 THEN 'sector' WHEN 1 THEN 'head' ELSE 'total' END "
                             "AS level, Practice_Head, Sector, count(*) AS row_count FROM sm "
                             "WHERE Practice_Head IS NOT NULL AND Sector IS NOT NULL GROUP BY ROLLUP (Practice_Head, Sector)"),
    "role_kpis": q(f"SELECT role, count(*) AS total, CAST(count_if(lower(contact_response) = 'registered') AS BIGINT) AS registered, "
                   f"{RATE(f'count_if({_RESP})', 'count(*)')} AS response_rate FROM sc GROUP BY role"),
    "role_responses": q("SELECT role, Response AS response, CAST(sum(Response_Weight) AS BIGINT) AS weight FROM sc "
                        "WHERE Response IS NOT NULL GROUP BY ALL"),
    "role_region": q(role_region("SELECT * FROM sc")),
    "role_region_filtered": q(role_region(cascade("sc", filt(FILTER_SPEC)))),
    "cfo_sectors": q("SELECT Sector AS sector, count(*) AS row_count FROM sc WHERE role = 'cfo' AND Sector IS NOT NULL GROUP BY 1"),
    "metrics": q(f"SELECT {RATE('sum(' + SI('numRegistrations') + ')', 'sum(' + SI('numInvitees') + ')')} AS conversion_rate, "
                 f"{RATE('count(Response)', 'count(*)')} AS response_rate, CAST(count_if(Response IS NULL) AS BIGINT) AS pending_followups, "
                 "count(Circle_Back_Dt) AS circle_backs FROM sm"),
    "invite_trend": q(f"SELECT {PDATE('Invite_Dt')} AS invite_date, count(*) AS invites FROM sm "
                      f"WHERE {PDATE('Invite_Dt')} IS NOT NULL GROUP BY 1"),
    "funnel": with_extra(
        f"a AS (SELECT count(*) AS s1, CAST(sum({SI('numInvitees')}) AS BIGINT) AS s2, count(Response) AS s3, "
        f"CAST(sum({SI('numRegistrations')}) AS BIGINT) AS s4 FROM sm)",
        " UNION ALL ".join(f"SELECT CAST({i} AS INTEGER) AS stage_no, '{n}' AS stage, CAST({v} AS BIGINT) AS value, "
                           f"{RATE(v, 's1')} AS pct_initial FROM a"
                           for i, n, v in ((1, "Total Clients", "s1"), (2, "Total Invitees", "s2"),
                                           (3, "Responses", "s3"), (4, "Registrations", "s4")))),
    "filter_options": q(" UNION ALL ".join(
        f"SELECT DISTINCT '{k}' AS dimension, CAST({c} AS VARCHAR) AS value FROM sm WHERE {c} IS NOT NULL"
        for k, c in (("ph", "Practice_Head"), ("partner", "Partner"), ("sector", "Sector"), ("loc", "Location"),
                     ("resp", "Response")))),
    "dup_phones": q(dup_sql()),
    "dup_phone_people": with_extra(f"d AS ({dup_sql()})",
                                   "SELECT c.role, c.phone, c.id, c.client || ' (' || c.name || ')' AS person, d.dup_count "
                                   "FROM c JOIN d ON c.role = d.role AND c.phone = d.phone "
                                   "WHERE c.client IS NOT NULL AND c.name IS NOT NULL"),
    "dup_phones_top": DUP_TOP,
    "dup_phone_counts": with_extra(f"d AS ({dup_sql()})", "SELECT role, count(*) AS dup_phones FROM d GROUP BY role"),
    "reconcile": reconcile_sql(),
    "reconcile_rows": q("SELECT role, id, phone, 'missing_in_derived' AS side FROM (SELECT role, id, phone FROM c EXCEPT ALL "
                        "SELECT role, id, phone FROM u) UNION ALL SELECT role, id, phone, 'extra_in_derived' FROM "
                        "(SELECT role, id, phone FROM u EXCEPT ALL SELECT role, id, phone FROM c)"),
    "reconcile_registered": reconcile_sql("contact_response IN ('Registered', 'registered')"),
    "names_title": q("SELECT id, " + ", ".join(f"{T(c)} AS t_{c}" for c in
                                              ("Practice_Head", "Partner", "Client_Name", "Location", "Sector")) + " FROM m"),
    "safe_ints": q(f"SELECT id, {SI('numInvitees')} AS invitees, {SI('numRegistrations')} AS registrations, "
                   f"{RATE(SI('numRegistrations'), SI('numInvitees'))} AS conversion FROM m"),
    "numeric_coercion": q(f"SELECT id, {NP('numRegistrations')} AS n_reg, {NP('Response_1')} AS n_resp1, "
                          f"{NP('Response')} AS n_resp FROM m"),
    "regions": q(f"SELECT id, {REGION('Location')} AS r_tax, {REGION('Location_6')} AS r_cfo, "
                 f"{REGION('Location_12')} AS r_other FROM m"),
    "labels_weights": q(f"SELECT id, {LABEL('Response')} AS label, {WEIGHT('Response')} AS weight, "
                        f"{LABEL('Response_7')} AS label7, {WEIGHT('Response_7')} AS weight7 FROM m"),
    "dates": q(f"SELECT id, {PDATE('Invite_Dt')} AS invite_date, {PDATE('Circle_Back_Dt')} AS circle_back_date FROM m"),
    "eligible_cards": q("SELECT * FROM elig"),
    "cards": q(f"SELECT role, id, client, name, phone, {_CARD} AS card FROM elig"),
    "mark_exported": q("SELECT u.*, CAST(CASE WHEN e.phone IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS Contact_Created_Status, "
                       f"CASE WHEN e.phone IS NOT NULL THEN {_TS} END AS Contact_File_Created_Time_Stamp "
                       "FROM u LEFT JOIN (SELECT role, phone FROM elig) e ON u.role = e.role AND u.phone = e.phone"),
    "pending": q("SELECT role, count(*) AS pending FROM u WHERE NOT EXISTS (SELECT 1 FROM elig e WHERE e.role = u.role "
                 "AND e.phone = u.phone) GROUP BY role"),
    "card_files": q(f"SELECT role, {_CARD} AS card FROM elig"),
    "cards_two_batches": q(f"SELECT CASE WHEN id % 2 = 0 THEN 'b1' ELSE 'b2' END AS batch_id, role, {_CARD} AS card FROM elig"),
    "replicated_copy": q("SELECT * EXCLUDE (id) FROM m"),
    "stream_changes": q("SELECT * FROM c2"),
    "stream_changes_out_of_order": q("SELECT * FROM c2"),
    "stream_overview": _OVERVIEW,
    "stream_response_weights": _RESPONSE_WEIGHTS,
    "stream_role_region": q(role_region("SELECT * FROM sc")),
    "stream_trend": q(f"SELECT {PDATE('Invite_Dt')} AS invite_date, count(*) AS invites FROM sm "
                      f"WHERE {PDATE('Invite_Dt')} IS NOT NULL GROUP BY 1"),
    "stream_trend_windowed": q(f"SELECT {PDATE('Invite_Dt')} AS invite_date, count(*) AS invites FROM sm "
                      f"WHERE {PDATE('Invite_Dt')} IS NOT NULL GROUP BY 1"),
}
ORACLE_SQL["apply_changes_audit"] = ORACLE_SQL["stream_changes_audit"]
ORACLE_SQL["apply_change_counts"] = ORACLE_SQL["stream_change_counts"]
