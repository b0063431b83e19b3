"""The same queries as ANSI SQL, for the engine the results are compared with."""

from __future__ import annotations

from driver_roles import ROLES_SQL

ORACLE: dict[str, str] = {}

SITE = "CASE WHEN {0} % 2 <> 0 THEN 'AM' ELSE 'EU' END"
TICKET_ORDER = "id_bilet, id_zbor, id_pasager, numar_rand, litera_scaun, clasa, pret_final"
FLIGHT_COLUMNS = (
    "id_zbor, id_avion, id_aeroport_plecare, id_aeroport_sosire, numar_zbor, data_plecare, "
    "data_sosire, data_plecare_efectiva, data_sosire_efectiva, durata_estimata, "
    "CAST(pret_standard AS DOUBLE) pret_standard, status"
)
BOOKING_COLUMNS = (
    "id_rezervare, id_user, data_rezervare, regiune_vanzare, "
    "CAST(total_de_plata AS DOUBLE) total_de_plata, status"
)
EMAIL = "regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$')"


def sql(name: str, body: str, *ctes: str) -> None:
    ORACLE[name] = "WITH " + ", ".join([ROLES_SQL.strip(), *ctes]) + " " + body


# --- sources ---------------------------------------------------------------------------

sql("scan_typed", """SELECT o_orderkey, o_custkey, o_orderstatus,
    CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) o_totalprice, o_orderdate FROM orders""")
sql("scan_site", f"SELECT {FLIGHT_COLUMNS} FROM zbor")
sql("synonym_scan", "SELECT * FROM avion")
sql("replicate_full", """SELECT site, id_zbor, data_plecare,
    CAST(pret_standard AS DOUBLE) pret_standard, status
    FROM zbor, (VALUES ('AM'), ('EU')) s(site)""")
sql("append_rows", f"""SELECT {BOOKING_COLUMNS} FROM v_rezervare WHERE id_rezervare % 2 <> 0
    UNION ALL SELECT 9970001, 1, TIMESTAMP '2001-08-01 00:00:00', 'AM', 350.01, 'CONFIRMATA'""")
sql("insert_if_absent", """SELECT document, origin FROM known UNION ALL
    SELECT document, min(origin) FROM seen
    WHERE document NOT IN (SELECT document FROM known) GROUP BY document""",
    "known AS (SELECT 'XY' || c_custkey document, c_custkey origin FROM customer WHERE c_acctbal >= 0)",
    "seen AS (SELECT 'XY' || o_custkey document, o_orderkey origin FROM orders)")
sql("fk_lookup", """SELECT p.id_pasager, p.nationalitate, a.id_aeroport
    FROM pasager p LEFT JOIN aeroport a ON p.nationalitate = a.cod_iata""")
sql("position_lookup", """SELECT o_orderkey, o_custkey * 2 + 1 AS "position", z.id_zbor
    FROM orders LEFT JOIN (SELECT id_zbor, row_number() OVER (ORDER BY id_zbor) rn FROM zbor) z
    ON z.rn = o_custkey * 2 + 1""")

# --- fragmentation ---------------------------------------------------------------------

for _site in ("AM", "EU"):
    sql(f"fragment_primary_{_site.lower()}",
        f"SELECT {BOOKING_COLUMNS} FROM rezervare WHERE regiune_vanzare = '{_site}'")
sql("fragment_written", """SELECT regiune_vanzare, count(*) bookings,
    CAST(sum(total_de_plata) AS DOUBLE) total FROM rezervare GROUP BY 1""")
sql("fragment_derived", """SELECT id_bilet, id_rezervare, id_zbor, id_pasager, numar_rand,
    litera_scaun, clasa, CAST(pret_final AS DOUBLE) pret_final FROM bilet
    WHERE id_rezervare IN (SELECT id_rezervare FROM rezervare WHERE regiune_vanzare = 'AM')""")
sql("fragment_vertical", """SELECT 'sec' fragment, id_user, email AS "first", rol AS "last" FROM utilizator
    UNION ALL SELECT 'data', id_user, nume, telefon FROM utilizator""")
sql("verify_fragmentation", """SELECT * FROM (VALUES ('complete', CAST(0 AS BIGINT), true),
    ('disjoint', CAST(0 AS BIGINT), true), ('rebuild', CAST(0 AS BIGINT), true)) t("check", violations, ok)""")
sql("verify_incomplete", """SELECT 'complete' AS "check", count(*) violations, count(*) = 0 ok
    FROM rezervare WHERE regiune_vanzare = 'OTHER'
    UNION ALL SELECT 'disjoint', 0, true UNION ALL SELECT 'rebuild', 0, true""")
sql("verify_overlap", """SELECT "check", violations, violations = 0 ok FROM (
    SELECT 'complete' "check", count(*) violations FROM rezervare WHERE regiune_vanzare = 'EU'
      AND id_rezervare % 7 = 0 AND total_de_plata <> 0 AND status <> 'ANULATA'
    UNION ALL SELECT 'disjoint', count(*) FROM rezervare WHERE status = 'ANULATA'
    UNION ALL SELECT 'rebuild', count(*) FILTER (regiune_vanzare = 'EU' AND id_rezervare % 7 = 0 AND total_de_plata <> 0)
      + count(*) FILTER (status = 'ANULATA'
        AND NOT (regiune_vanzare = 'EU' AND id_rezervare % 7 = 0 AND total_de_plata <> 0)) FROM rezervare)""")
sql("verify_vertical_broken", """SELECT "check", violations, violations = 0 ok FROM (
    SELECT 'complete' "check", count(*) FILTER (id_user % 10 = 3) violations FROM utilizator
    UNION ALL SELECT 'disjoint', 0
    UNION ALL SELECT 'rebuild', count(*) FILTER (id_user % 10 = 3) FROM utilizator)""")
ORACLE["verify_minterms"] = ORACLE["verify_fragmentation"]
sql("minterm_fragments", """SELECT fragment, count(*) bookings,
    CAST(sum(CASE WHEN regiune_vanzare = 'AM' THEN 1 ELSE 0 END) AS BIGINT) read_desk_am,
    CAST(sum(CASE WHEN regiune_vanzare = 'EU' THEN 1 ELSE 0 END) AS BIGINT) read_desk_eu,
    CAST(sum(CASE WHEN total_de_plata >= 200000 AND regiune_vanzare <> 'OTHER' THEN 1 ELSE 0 END) AS BIGINT) read_audit
    FROM (SELECT *, CASE WHEN regiune_vanzare = 'AM' THEN '' ELSE 'NOT ' END || 'am AND '
      || CASE WHEN regiune_vanzare = 'EU' THEN '' ELSE 'NOT ' END || 'eu AND '
      || CASE WHEN total_de_plata >= 200000 THEN '' ELSE 'NOT ' END || 'large' fragment FROM rezervare)
    GROUP BY fragment""")
# All orders of the columns and all splits of the strongest one.
ORACLE["affinity_split"] = """WITH RECURSIVE reads(call, a) AS (VALUES ('view', 'nume'), ('view', 'prenume'), ('click', 'nume'),
    ('click', 'prenume'), ('click', 'telefon'), ('signup', 'email'), ('signup', 'parola'), ('signup', 'rol'),
    ('error', 'email'), ('error', 'rol'), ('purchase', 'nume'), ('purchase', 'email'), ('purchase', 'telefon')),
  usage AS (SELECT call, a, n FROM reads JOIN (SELECT event_type call, count(*) n FROM events GROUP BY 1) USING (call)),
  names AS (SELECT DISTINCT a FROM usage),
  together AS (SELECT x.a, y.a b, sum(x.n) n FROM usage x JOIN usage y ON x.call = y.call GROUP BY 1, 2),
  bonds AS (SELECT x.b a, y.b, sum(x.n * y.n) bond FROM together x JOIN together y ON x.a = y.a GROUP BY 1, 2),
  orders(o, strength) AS (SELECT [a], CAST(0 AS HUGEINT) FROM names UNION ALL
    SELECT list_append(o, names.a), strength + coalesce((SELECT bond FROM bonds WHERE bonds.a = o[-1] AND b = names.a), 0)
    FROM orders JOIN names ON NOT list_contains(o, names.a)),
  best AS (SELECT o FROM orders WHERE len(o) = (SELECT count(*) FROM names) ORDER BY strength DESC, o LIMIT 1),
  splits AS (SELECT o, i, j, list_slice(o, i + 1, j) part FROM best, unnest(range(1, len(o))) p(i), unnest(range(2, len(o) + 1)) q(j) WHERE j > i),
  calls AS (SELECT list(a) columns, any_value(n) n FROM usage GROUP BY call),
  judged AS (SELECT o, i, j, part, sum(CASE WHEN list_has_all(part, columns) THEN n ELSE 0 END) t,
    sum(CASE WHEN NOT list_has_any(part, columns) THEN n ELSE 0 END) b, sum(n) every FROM splits, calls GROUP BY ALL),
  chosen AS (SELECT o, part FROM judged ORDER BY t * b - (every - t - b) * (every - t - b) DESC, j - i, i LIMIT 1)
  SELECT CAST(k AS INTEGER) "position", o[k] "attribute", CASE WHEN list_contains(part, o[k]) THEN 2 ELSE 1 END fragment
  FROM chosen, unnest(range(1, len(o) + 1)) u(k)"""
ORACLE["verify_vertical"] = ORACLE["verify_fragmentation"]

# --- surrogate keys --------------------------------------------------------------------

_MAP = """SELECT id_rezervare old_id, row_number() OVER (ORDER BY id_rezervare) * 2 - {1} new_id
    FROM rezervare WHERE regiune_vanzare = '{0}'"""
sql("remap_keys_am", _MAP.format("AM", 1))
sql("remap_keys_eu", _MAP.format("EU", 0))
sql("remap_keys_sites", f"""SELECT old_id, 'AM' regiune_vanzare, new_id FROM ({_MAP.format('AM', 1)})
    UNION ALL SELECT old_id, 'EU', new_id FROM ({_MAP.format('EU', 0)})""")
sql("remap_children", f"""SELECT row_number() OVER (ORDER BY {TICKET_ORDER}) * 2 - 1 id_bilet,
    new_id id_rezervare, id_zbor, id_pasager, numar_rand, litera_scaun, clasa,
    CAST(pret_final AS DOUBLE) pret_final
    FROM bilet JOIN ({_MAP.format('AM', 1)}) m ON id_rezervare = old_id""")
sql("next_key", """SELECT 'AM' site, max(id_rezervare) + 2 next_key FROM booking WHERE id_rezervare % 2 <> 0
    UNION ALL SELECT 'EU', max(id_rezervare) + 2 FROM booking WHERE id_rezervare % 2 = 0
    UNION ALL SELECT 'AM empty', 1 UNION ALL SELECT 'EU empty', 2""")
sql("max_default", "SELECT coalesce(max(id_plata), -1) max_value FROM plata")
sql("allocate_keys", """SELECT n.tag, CAST(p.suma_achitata AS DOUBLE) suma_achitata, p.metoda_plata,
    n.id_rezervare FROM plata p JOIN fresh n ON p.id_rezervare = n.tag""",
    """fresh AS (SELECT id_rezervare tag,
        (SELECT max(id_rezervare) + 2 FROM booking WHERE id_rezervare % 2 <> 0)
        + 2 * (row_number() OVER (ORDER BY data_rezervare, id_rezervare) - 1) id_rezervare
        FROM rezervare WHERE regiune_vanzare = 'OTHER')""")

# --- global views ----------------------------------------------------------------------

sql("view_union_all", f"SELECT {BOOKING_COLUMNS}, regiune_vanzare site FROM v_rezervare")
sql("view_vertical_join", """SELECT id_user, nume, prenume, email, parola, telefon,
    data_inregistrare, rol FROM utilizator""")

sql("global_names_pruned", """SELECT 'AM' site, status, count(*) bookings FROM v_rezervare
    WHERE regiune_vanzare = 'AM' GROUP BY status""")
sql("global_names", """SELECT regiune_vanzare, nume_tara, count(*) tickets, count(DISTINCT id_user) users
    FROM bilet JOIN v_rezervare USING (id_rezervare) JOIN zbor USING (id_zbor)
    JOIN aeroport ON id_aeroport_plecare = id_aeroport JOIN oras USING (id_oras) JOIN tara USING (id_tara)
    GROUP BY 1, 2""")

# --- projections, filters, expressions -------------------------------------------------

sql("project_alias", "SELECT nume client, id_user, rol, rol = 'ADMIN' is_admin FROM utilizator")
sql("filter_compare", f"""SELECT {BOOKING_COLUMNS} FROM rezervare
    WHERE data_rezervare >= TIMESTAMP '1998-01-01 00:00:00' AND status <> 'ANULATA'
    AND regiune_vanzare = 'EU'""")
sql("filter_in", """SELECT id_plata, metoda_plata FROM plata
    WHERE metoda_plata IN ('CARD', 'TRANSFER_BANCAR')""")
sql("filter_range", """SELECT id_bilet, numar_rand, litera_scaun FROM bilet
    WHERE numar_rand > 10 AND numar_rand <= 30""")
sql("not_exists", """SELECT id_rezervare, id_user, CASE WHEN EXISTS (SELECT 1 FROM bilet b
    WHERE b.id_rezervare = r.id_rezervare AND b.clasa = 'BUSINESS') THEN 'some' ELSE 'none' END business
    FROM rezervare r""")
sql("string_ops", """SELECT id_user, nume || ' / ' || coalesce(telefon, '') AS "label",
    upper(email) upper_email, prenume = upper(prenume) is_upper,
    length(telefon) IN (3, 4, 5) short_phone, CAST(length(nume) AS INTEGER) name_length FROM utilizator""")
sql("check_email", f"SELECT id_user, email, {EMAIL} email_ok FROM utilizator")
sql("format_timestamp", "SELECT id_zbor, strftime(data_plecare, '%Y-%m-%d %H:%M') leaves FROM zbor")
sql("months_window", """SELECT id_rezervare, data_rezervare,
    CASE WHEN month_end THEN CAST(last_day(data_rezervare - INTERVAL 1 MONTH) AS TIMESTAMP)
      ELSE data_rezervare - INTERVAL 1 MONTH END month_before,
    CASE WHEN month_end THEN CAST(last_day(data_rezervare + INTERVAL 1 MONTH) AS TIMESTAMP)
      ELSE data_rezervare + INTERVAL 1 MONTH END month_after
    FROM (SELECT *, CAST(data_rezervare AS DATE) = last_day(data_rezervare) month_end FROM rezervare)
    WHERE data_rezervare >= TIMESTAMP '2001-02-01 00:00:00'""")
sql("nvl_default", "SELECT id_user, coalesce(telefon, 'N/A') telefon FROM utilizator")
sql("route_parity", f"""SELECT id_rezervare - 5000 AS "key", {SITE.format('(id_rezervare - 5000)')} site
    FROM rezervare""")
sql("occupancy_pct", """SELECT id_zbor, sold,
    ((sold * 20000 + capacitate) // (2 * capacitate)) / 100.0 pct
    FROM (SELECT id_zbor, count(*) sold FROM bilet GROUP BY 1) JOIN zbor USING (id_zbor)
    JOIN avion USING (id_avion)""")
sql("ticket_price", """SELECT id_bilet, id_zbor, clasa,
    CAST(CASE WHEN clasa = 'BUSINESS' THEN CAST(pret_standard * 1.5 AS DECIMAL(10,2)) ELSE pret_standard END AS DOUBLE) price,
    CAST(CASE WHEN clasa = 'BUSINESS' THEN CAST(pret_standard * 1.8 AS DECIMAL(10,2)) ELSE pret_standard END AS DOUBLE) price_18
    FROM bilet JOIN zbor USING (id_zbor)""")
sql("booking_total", """SELECT id_rezervare, CAST(sum(pret_final) AS DOUBLE) total_de_plata,
    count(*) bilete FROM bilet GROUP BY 1""")
sql("status_at", """SELECT id_zbor, CASE WHEN data_plecare > a THEN 'PROGRAMAT'
    WHEN id_zbor % 19 = 0 THEN 'ANULAT'
    WHEN coalesce(data_plecare_efectiva, data_plecare) > a THEN 'INTARZIAT'
    WHEN data_sosire_efectiva > a THEN 'IN_ZBOR' ELSE 'ATERIZAT' END status
    FROM zbor, (SELECT TIMESTAMP '2001-08-01 00:00:00' a)""")
sql("derive_states", """SELECT id_bilet, id_zbor,
    CASE status WHEN 'ANULAT' THEN 'ANULATA' ELSE 'CONFIRMATA' END status_rezervare,
    CASE status WHEN 'ANULAT' THEN 'RAMBURSATA' ELSE 'ACCEPTATA' END status_plata
    FROM bilet JOIN zbor USING (id_zbor)""")
sql("insert_defaults", """SELECT o_orderkey id_rezervare, o_custkey id_user,
    CASE WHEN o_orderpriority = '5-LOW' THEN TIMESTAMP '2001-08-01 00:00:00' ELSE o_orderdate END data_rezervare,
    CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) total_de_plata,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'IN_ASTEPTARE' ELSE o_orderstatus END status,
    'AM' regiune_vanzare FROM orders""")
LAYOUT_ROWS = """CASE model WHEN 'Boeing 737-800' THEN 32 WHEN 'Airbus A320' THEN 30
    WHEN 'Boeing 737-700' THEN 25 WHEN 'Boeing 737 MAX 8' THEN 34 WHEN 'ATR 72-600' THEN 18 ELSE 30 END"""
LAYOUT_LETTERS = "CASE WHEN model = 'ATR 72-600' THEN 'ACDF' ELSE 'ABCDEF' END"
SEAT_OK = f"(strpos({LAYOUT_LETTERS}, litera_scaun) > 0 AND numar_rand BETWEEN 1 AND {LAYOUT_ROWS})"
sql("seat_valid", f"""SELECT id_bilet, id_zbor, numar_rand, litera_scaun, {SEAT_OK} seat_ok
    FROM bilet JOIN zbor USING (id_zbor) JOIN avion USING (id_avion)""")
sql("row_label", """SELECT id_plata, suma_achitata || ' lei for booking ' || id_rezervare || ' (' || status
    || '), payment ' || id_plata AS "label" FROM plata""")
sql("distinct_departures", "SELECT DISTINCT id_aeroport_plecare, status FROM zbor")

# --- joins, aggregates, ranking --------------------------------------------------------

sql("join_chain", """SELECT regiune_vanzare, model, nume_tara, count(*) tickets
    FROM bilet JOIN rezervare USING (id_rezervare) JOIN zbor USING (id_zbor)
    JOIN avion USING (id_avion) JOIN aeroport ON id_aeroport_plecare = id_aeroport
    JOIN oras USING (id_oras) JOIN tara USING (id_tara) GROUP BY ALL""")
sql("role_playing_dims", """SELECT id_zbor, id_aeroport_plecare, id_aeroport_sosire,
    d.cod_iata cod_iata_plecare, s.cod_iata cod_iata_sosire FROM zbor
    JOIN aeroport d ON id_aeroport_plecare = d.id_aeroport
    JOIN aeroport s ON id_aeroport_sosire = s.id_aeroport""")
sql("hash_join_hint", """SELECT id_zbor, count(*) sold, id_avion, capacitate
    FROM bilet JOIN zbor USING (id_zbor) JOIN avion USING (id_avion) GROUP BY ALL""")
sql("join_cross_site", """SELECT nationalitate, count(*) tickets FROM bilet JOIN pasager USING (id_pasager)
    WHERE id_rezervare % 2 = 0 GROUP BY 1""")
sql("join_where", """SELECT id_zbor, count(*) tickets FROM bilet JOIN zbor z USING (id_zbor)
    WHERE z.status = 'ANULAT' GROUP BY 1""")
sql("route_totals", """SELECT id_zbor, count(id_bilet) tickets, count(*) AS "rows",
    CAST(sum(pret_final) AS DOUBLE) revenue FROM bilet GROUP BY 1""")
sql("nationality_counts", """SELECT id_zbor, nationalitate, count(*) cnt
    FROM bilet JOIN pasager USING (id_pasager) GROUP BY ALL""")
_COUNTED = "(SELECT id_zbor, nationalitate, count(*) cnt FROM bilet JOIN pasager USING (id_pasager) GROUP BY ALL)"
sql("mode_by_key", f"""SELECT id_zbor, nationalitate AS "mode" FROM {_COUNTED} QUALIFY
    row_number() OVER (PARTITION BY id_zbor ORDER BY cnt DESC, nationalitate) = 1""")
sql("rank_over_aggregate", f"""SELECT id_zbor, nationalitate, cnt,
    rank() OVER (PARTITION BY id_zbor ORDER BY cnt DESC) rnk FROM {_COUNTED}""")
sql("match_count", """SELECT id_user, count(id_rezervare) matches FROM utilizator
    LEFT JOIN rezervare USING (id_user) GROUP BY 1""")

# --- order and limits ------------------------------------------------------------------

sql("sort_nulls", "SELECT id_zbor, data_plecare_efectiva FROM zbor ORDER BY 2 DESC NULLS FIRST, 1")
sql("topk", "SELECT id_user, telefon, rol FROM utilizator ORDER BY telefon DESC NULLS FIRST, id_user LIMIT 100")
sql("limit_rows", "SELECT id_user, nume, prenume FROM utilizator ORDER BY id_user LIMIT 100")

# --- changes and replication -----------------------------------------------------------


def _state(name: str, until: str = "true") -> tuple[str, str]:
    """CTEs with the accounts after the changes that satisfy ``until``."""
    return (
        f"""{name}_key AS (SELECT k.*, c.value, c.note,
            i IS NOT NULL AND (d IS NULL OR i > d) born, d IS NOT NULL AND (i IS NULL OR i < d) gone
            FROM (SELECT user_id, max(seq) FILTER (WHERE op = 'D') d, max(seq) FILTER (WHERE op = 'I') i,
              max(seq) FILTER (WHERE op <> 'D') w FROM chg WHERE {until} GROUP BY 1) k
            LEFT JOIN chg c ON c.seq = k.w)""",
        f"""{name} AS (SELECT coalesce(a.user_id, k.user_id) user_id,
            CASE WHEN k.user_id IS NULL THEN a.value ELSE k.value END AS value,
            CASE WHEN k.user_id IS NULL THEN a.note ELSE k.note END note
            FROM accounts a FULL JOIN {name}_key k ON a.user_id = k.user_id
            WHERE CASE WHEN k.gone THEN false WHEN k.born THEN true ELSE a.user_id IS NOT NULL END)""",
    )


_MIDDLE = "(SELECT max(event_id) // 2 FROM events)"
for _name in ("apply_changes", "apply_changes_bulk", "replica_after_changes", "replica_out_of_order",
              "refresh_incremental"):
    sql(_name, "SELECT user_id, value, note FROM after_all", *_state("after_all"))
sql("insert_conflicts", """SELECT DISTINCT user_id FROM (
    SELECT user_id, op, lag(op) OVER (PARTITION BY user_id ORDER BY seq) prev FROM chg WHERE op <> 'U')
    WHERE op = 'I' AND (prev = 'I' OR (prev IS NULL AND user_id IN (SELECT user_id FROM accounts)))""")
_DIFF = """SELECT CASE WHEN b.user_id IS NULL THEN 'I' WHEN a.user_id IS NULL THEN 'D' ELSE 'U' END op,
    coalesce(a.user_id, b.user_id) user_id, a.value, a.note
    FROM after_all a FULL JOIN {0} b ON a.user_id = b.user_id
    WHERE a.user_id IS NULL OR b.user_id IS NULL OR a.value IS DISTINCT FROM b.value
      OR a.note IS DISTINCT FROM b.note"""
sql("capture_changes", f"SELECT *, row_number() OVER (ORDER BY user_id) seq FROM ({_DIFF.format('accounts')})",
    *_state("after_all"))
sql("replica_stale", _DIFF.format("halfway"), *_state("after_all"), *_state("halfway", f"seq <= {_MIDDLE}"))
sql("compare_replicas", """SELECT coalesce(a.user_id, b.user_id) user_id,
    CASE WHEN b.user_id IS NULL THEN 'only_a' WHEN a.user_id IS NULL THEN 'only_b'
      WHEN a.value IS NOT DISTINCT FROM b.value AND a.note IS NOT DISTINCT FROM b.note THEN 'same'
      ELSE 'diff' END state
    FROM after_all a FULL JOIN accounts b ON a.user_id = b.user_id""", *_state("after_all"))
sql("route_update", """SELECT r.id_rezervare, id_user, data_rezervare, regiune_vanzare,
    CAST(coalesce(t.total, total_de_plata) AS DOUBLE) total_de_plata, coalesce(s.status, r.status) status,
    regiune_vanzare site FROM v_rezervare r
    LEFT JOIN (SELECT user_id, arg_max(CASE event_type WHEN 'click' THEN 'CONFIRMATA'
        WHEN 'purchase' THEN 'FINALIZATA' ELSE 'ANULATA' END, event_id) status FROM events
        WHERE event_type IN ('click', 'purchase', 'error') GROUP BY 1) s ON s.user_id = r.id_rezervare
    LEFT JOIN (SELECT user_id, arg_max(CAST(value AS DECIMAL(10,2)), event_id) total FROM events
        WHERE event_type IN ('view', 'purchase', 'error') GROUP BY 1) t ON t.user_id = r.id_rezervare""")
_PROFILE = """SELECT id_user, coalesce('name ' || n.seq, nume) nume, coalesce(p.kind, prenume) prenume,
    CASE WHEN f.seq IS NULL THEN telefon WHEN e.event_type = 'view' THEN CAST(f.seq AS VARCHAR) END telefon,
    data_inregistrare FROM utilizator
    LEFT JOIN (SELECT user_id, max(event_id) seq FROM events
        WHERE event_type IN ('click', 'purchase') GROUP BY 1) n ON n.user_id = id_user
    LEFT JOIN (SELECT DISTINCT user_id, event_type kind FROM events
        WHERE event_type = 'purchase') p ON p.user_id = id_user
    LEFT JOIN (SELECT user_id, max(event_id) seq FROM events
        WHERE event_type IN ('view', 'signup') GROUP BY 1) f ON f.user_id = id_user
    LEFT JOIN events e ON e.event_id = f.seq"""
sql("route_update_vertical", _PROFILE)
sql("propagate_chain", f"SELECT p.*, site FROM ({_PROFILE}) p, (VALUES ('AM'), ('EU')) s(site)")
sql("update_by_key", """SELECT id_zbor, CAST(coalesce(price, pret_standard) AS DOUBLE) pret_standard, status
    FROM zbor LEFT JOIN (SELECT user_id, arg_max(CAST(value AS DECIMAL(10,2)), event_id) price
      FROM events GROUP BY 1) ON user_id = id_zbor""")
sql("cancel_bookings", """SELECT 'booking' kind, r.regiune_vanzare site, r.id_rezervare,
    CASE WHEN c.id IS NULL THEN r.status ELSE 'ANULATA' END status
    FROM v_rezervare r LEFT JOIN cancelled c ON c.id = r.id_rezervare
    UNION ALL SELECT 'payment', CASE WHEN p.id_rezervare % 2 <> 0 THEN 'AM' ELSE 'EU' END, p.id_rezervare,
    CASE WHEN c.id IS NULL THEN p.status ELSE 'RAMBURSATA' END
    FROM plata p LEFT JOIN cancelled c ON c.id = p.id_rezervare""",
    "cancelled AS (SELECT DISTINCT l_orderkey id FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)")
ORACLE["cancel_published"] = ORACLE["cancel_bookings"]
_REVIEW = (
    """request AS (SELECT o_orderkey request_id, o_custkey id_user, o_custkey id_zbor,
        o_custkey + 30 id_pasager, o_orderkey % 36 + 1 numar_rand,
        substr('ABCDG', CAST(substr(o_orderpriority, 1, 1) AS INTEGER), 1) litera_scaun,
        CASE o_orderstatus WHEN 'P' THEN 'BUSINESS' ELSE 'ECONOMY' END clasa FROM orders)""",
    f"""judged AS (SELECT q.*, CAST(CASE WHEN clasa = 'BUSINESS' THEN CAST(pret_standard * 1.5 AS DECIMAL(10,2))
          ELSE pret_standard END AS DOUBLE) pret_final,
        CASE WHEN z.id_zbor IS NULL THEN 'unknown flight'
          WHEN NOT EXISTS (SELECT 1 FROM pasager p WHERE p.id_pasager = q.id_pasager) THEN 'unknown passenger'
          WHEN NOT {SEAT_OK} THEN 'no such seat'
          WHEN EXISTS (SELECT 1 FROM bilet b WHERE b.id_zbor = q.id_zbor AND b.numar_rand = q.numar_rand
            AND b.litera_scaun = q.litera_scaun) THEN 'seat taken' END reason
        FROM request q LEFT JOIN zbor z ON z.id_zbor = q.id_zbor LEFT JOIN avion a ON a.id_avion = z.id_avion)""",
    """ranked AS (SELECT *, CASE WHEN reason IS NOT NULL THEN reason WHEN row_number() OVER (
        PARTITION BY reason IS NULL, id_zbor, numar_rand, litera_scaun ORDER BY request_id) > 1
        THEN 'seat taken' END verdict FROM judged)""",
)
sql("book_refused", "SELECT request_id, verdict reason FROM ranked WHERE verdict IS NOT NULL", *_REVIEW)
sql("book_batch", """SELECT (SELECT max(id_bilet) FROM bilet WHERE id_rezervare % 2 = 0) + 2 * rn id_bilet,
    (SELECT max(id_rezervare) FROM booking WHERE id_rezervare % 2 = 0) + 2 * rn id_rezervare,
    (SELECT max(id_rezervare) FROM booking WHERE id_rezervare % 2 = 0) + 2 * rn id_plata,
    id_zbor, id_pasager, numar_rand, litera_scaun, clasa, pret_final, id_user,
    TIMESTAMP '2001-08-01 00:00:00' data_rezervare, 'EU' regiune_vanzare,
    pret_final total_de_plata, 'CONFIRMATA' status, pret_final suma_achitata,
    TIMESTAMP '2001-08-01 00:00:00' data_plata, 'CARD' metoda_plata
    FROM (SELECT *, row_number() OVER (ORDER BY request_id) rn FROM ranked WHERE verdict IS NULL)""", *_REVIEW)
ORACLE["book_published"] = ORACLE["book_batch"]
sql("book_twice", """SELECT (SELECT max(id_bilet) FROM bilet WHERE id_rezervare % 2 = 0) + 2 * rn id_bilet,
    (SELECT max(id_rezervare) FROM booking WHERE id_rezervare % 2 = 0) + 2 * rn id_rezervare,
    (SELECT max(id_rezervare) FROM booking WHERE id_rezervare % 2 = 0) + 2 * rn id_plata,
    id_user, id_zbor, numar_rand, litera_scaun
    FROM (SELECT *, row_number() OVER (ORDER BY request_id % 2, request_id) rn FROM
      (SELECT *, row_number() OVER (PARTITION BY id_zbor, numar_rand, litera_scaun
        ORDER BY request_id % 2, request_id) place FROM judged WHERE reason IS NULL)
      WHERE place = 1)""", *_REVIEW)
sql("snapshot_read", """SELECT version, count(DISTINCT b.id_rezervare) bookings, CAST(count(*) AS BIGINT) tickets
    FROM bilet b JOIN booking k ON k.id_rezervare = b.id_rezervare, (VALUES ('before'), ('after')) v(version)
    WHERE b.id_rezervare % 2 = 0 AND (version = 'before' OR b.id_rezervare % 4 <> 0) GROUP BY version""")
sql("admit_insert", """SELECT seq, rule, error FROM broken UNION ALL
    SELECT seq, CASE WHEN place > 1 THEN 'unique_id_zbor_numar_rand_litera_scaun_batch' END, NULL FROM placed""",
    """fresh AS (SELECT o_orderkey seq, o_orderkey id_rezervare, o_custkey id_zbor, o_custkey + 30 id_pasager,
      o_orderkey % 30 - 1 numar_rand, substr('ABCDEFGX', CAST(o_orderkey % 8 + 1 AS INTEGER), 1) litera_scaun,
      CAST(o_totalprice - 3000 AS DECIMAL(10,2)) pret_final FROM orders)""",
    """broken AS (SELECT seq, 'ticket_row' rule, CAST(NULL AS INTEGER) error FROM fresh WHERE NOT (numar_rand > 0 AND numar_rand <= 100)
      UNION ALL SELECT seq, 'ticket_letter', NULL FROM fresh WHERE litera_scaun NOT IN ('A','B','C','D','E','F','G','H','J','K')
      UNION ALL SELECT seq, 'ticket_price', NULL FROM fresh WHERE NOT pret_final > 0
      UNION ALL SELECT seq, 'fk_id_rezervare', NULL FROM fresh
        WHERE id_rezervare NOT IN (SELECT id_rezervare FROM booking WHERE id_rezervare % 2 = 0)
      UNION ALL SELECT seq, 'fk_id_zbor', NULL FROM fresh WHERE id_zbor NOT IN (SELECT id_zbor FROM zbor)
      UNION ALL SELECT seq, 'fk_id_pasager', -20002 FROM fresh WHERE id_pasager NOT IN (SELECT id_pasager FROM pasager)
      UNION ALL SELECT seq, CASE own WHEN 1 THEN 'unique_id_zbor_numar_rand_litera_scaun' ELSE 'unique_seat_sites' END,
        CASE own WHEN 0 THEN -20004 END FROM fresh f JOIN (SELECT DISTINCT id_zbor, numar_rand, litera_scaun,
          CASE WHEN id_rezervare % 2 = 0 THEN 1 ELSE 0 END own FROM bilet) b
        ON f.id_zbor = b.id_zbor AND f.numar_rand = b.numar_rand AND f.litera_scaun = b.litera_scaun)""",
    """placed AS (SELECT seq, row_number() OVER (PARTITION BY id_zbor, numar_rand, litera_scaun ORDER BY seq) place
      FROM fresh WHERE seq NOT IN (SELECT seq FROM broken))""")
sql("admit_update", """SELECT id_rezervare seq, CASE WHEN u.id_user IS NULL THEN 'fk_id_user' END rule,
    CAST(CASE WHEN u.id_user IS NULL THEN -20001 END AS INTEGER) error
    FROM booking b LEFT JOIN utilizator u ON u.id_user = b.id_user + 20 WHERE id_rezervare % 2 = 0""")
sql("delete_by_key", """SELECT id_bilet, id_rezervare, id_zbor FROM bilet WHERE id_rezervare NOT IN
    (SELECT id_rezervare FROM rezervare WHERE status = 'ANULATA')""")

# --- integrity -------------------------------------------------------------------------

# (table, rule, condition that holds for a good row)
ROW_RULES = [
    ("tara", "country_iso", "cod_iso_2 = upper(cod_iso_2) AND length(cod_iso_2) = 2"),
    ("aeroport", "airport_iata", "cod_iata = upper(cod_iata) AND length(cod_iata) = 3"),
    ("avion", "aircraft_capacity", "capacitate > 0 AND capacitate <= 850"),
    ("avion", "aircraft_year", "an_fabricatie >= 1950"),
    ("zbor", "flight_two_airports", "id_aeroport_plecare <> id_aeroport_sosire"),
    ("zbor", "flight_dates", "data_plecare < data_sosire"),
    ("zbor", "flight_price", "pret_standard > 0"),
    ("zbor", "flight_duration", "durata_estimata > 0"),
    ("zbor", "flight_status",
     "status IN ('PROGRAMAT', 'ANULAT', 'INTARZIAT', 'IMBARCAT', 'IN_ZBOR', 'ATERIZAT')"),
    ("pasager", "passenger_nationality", "length(nationalitate) IN (2, 3)"),
    ("utilizator", "user_email", EMAIL),
    ("utilizator", "user_role", "rol IN ('CLIENT', 'ADMIN')"),
    ("rezervare", "booking_region", "regiune_vanzare IN ('AM', 'EU')"),
    ("rezervare", "booking_total", "total_de_plata >= 0"),
    ("rezervare", "booking_status", "status IN ('IN_ASTEPTARE', 'CONFIRMATA', 'ANULATA', 'FINALIZATA')"),
    ("plata", "payment_amount", "suma_achitata > 0"),
    ("plata", "payment_method", "metoda_plata IN ('CARD', 'TRANSFER_BANCAR', 'CASH')"),
    ("plata", "payment_status", "status IN ('IN_PROCESARE', 'ACCEPTATA', 'RESPINSA', 'RAMBURSATA')"),
    ("bilet", "ticket_row", "numar_rand > 0 AND numar_rand <= 100"),
    ("bilet", "ticket_letter", "litera_scaun IN ('A', 'B', 'C', 'D', 'E', 'F', 'G', 'H', 'J', 'K')"),
    ("bilet", "ticket_class", "clasa IN ('ECONOMY', 'BUSINESS')"),
    ("bilet", "ticket_price", "pret_final > 0"),
]
KEYS = {
    "tara": "id_tara", "oras": "id_oras", "aeroport": "id_aeroport", "avion": "id_avion", "zbor": "id_zbor",
    "pasager": "id_pasager", "utilizator": "id_user", "rezervare": "id_rezervare", "plata": "id_plata",
    "bilet": "id_bilet",
}
sql("check_rules", " UNION ALL ".join(
    f"""SELECT '{rule}' AS "rule", '{table}' AS "name", CAST({KEYS[table]} AS VARCHAR) AS "key"
    FROM {table} WHERE NOT ({ok})""" for table, rule, ok in ROW_RULES))
sql("check_not_null", " UNION ALL ".join(
    f"""SELECT 'not_null_{c}' AS "rule", '{table}' AS "name", CAST({KEYS[table]} AS VARCHAR) AS "key",
    '{c}' detail FROM {table} WHERE {c} IS NULL"""
    for table, c in [("utilizator", "email"), ("utilizator", "telefon"), ("zbor", "data_plecare"),
                     ("zbor", "data_plecare_efectiva"), ("zbor", "data_sosire_efectiva")]))
sql("unique_local", """SELECT 'unique_l_orderkey_l_linenumber' AS "rule", 'lineitem' AS "name",
    l_orderkey || '|' || l_linenumber AS "key", CAST(count(*) AS VARCHAR) detail
    FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
_GOOD = f"(SELECT id_user FROM utilizator WHERE {EMAIL})"
sql("fk_local", f"""SELECT 'fk_id_user' AS "rule", 'rezervare' AS "name", CAST(id_rezervare AS VARCHAR) AS "key",
    CAST(id_user AS VARCHAR) detail FROM rezervare WHERE id_user NOT IN {_GOOD}""")
sql("fk_global", f"""SELECT 'fk_id_user_at_AM' AS "rule", 'rezervare_eu' AS "name",
    CAST(id_rezervare AS VARCHAR) AS "key", CAST(id_user AS VARCHAR) detail FROM v_rezervare
    WHERE id_rezervare % 2 = 0 AND id_user NOT IN {_GOOD}""")
_SEAT = "id_zbor, numar_rand, litera_scaun"
_SEAT_TEXT = "id_zbor || '|' || numar_rand || '|' || litera_scaun"
sql("unique_global", f"""SELECT 'unique_id_zbor_numar_rand_litera_scaun_sites' AS "rule", 'bilet_am' AS "name",
    CAST(id_bilet AS VARCHAR) AS "key", {_SEAT_TEXT} detail FROM bilet WHERE id_rezervare % 2 <> 0
    AND ({_SEAT}) IN (SELECT ({_SEAT}) FROM bilet WHERE id_rezervare % 2 = 0)""")
sql("unique_global_all", f"""SELECT 'unique_id_zbor_numar_rand_litera_scaun_sites' AS "rule", 'bilet' AS "name",
    {_SEAT_TEXT} AS "key", CAST(count(*) AS VARCHAR) detail FROM bilet GROUP BY {_SEAT} HAVING count(*) > 1""")
sql("unique_view", """SELECT 'unique_email' AS "rule", 'v_utilizator' AS "name", email AS "key",
    CAST(count(*) AS VARCHAR) detail FROM utilizator GROUP BY email HAVING count(*) > 1
    UNION ALL SELECT 'unique_id_bilet', 'v_bilet', CAST(id_bilet AS VARCHAR), CAST(count(*) AS VARCHAR)
    FROM bilet GROUP BY id_bilet HAVING count(*) > 1""")
sql("check_fragment_predicate", f"""SELECT 'fragment' AS "rule", 'rezervare_' || lower(site) AS "name",
    CAST(id_rezervare AS VARCHAR) AS "key", 'not of this fragment' detail
    FROM (SELECT *, {SITE.format('id_rezervare')} site FROM rezervare) WHERE regiune_vanzare <> site""")

REQUIRED = {
    "tara": ["id_tara", "nume_tara", "cod_iso_2"],
    "oras": ["id_oras", "id_tara", "nume_oras"],
    "aeroport": ["id_aeroport", "id_oras", "cod_iata", "nume_aeroport"],
    "avion": ["id_avion", "numar_inmatriculare", "model", "capacitate", "an_fabricatie"],
    "zbor": ["id_zbor", "id_avion", "id_aeroport_plecare", "id_aeroport_sosire", "numar_zbor", "data_plecare",
             "data_sosire", "durata_estimata", "pret_standard", "status"],
    "pasager": ["id_pasager", "nume", "prenume", "data_nasterii", "numar_document", "nationalitate"],
    "utilizator_sec": ["id_user", "email", "parola", "rol"],
    "utilizator_data": ["id_user", "nume", "prenume", "data_inregistrare"],
    "rezervare": ["id_rezervare", "id_user", "data_rezervare", "regiune_vanzare", "total_de_plata", "status"],
    "plata": ["id_plata", "id_rezervare", "suma_achitata", "data_plata", "metoda_plata", "status"],
    "bilet": ["id_bilet", "id_rezervare", "id_zbor", "id_pasager", "numar_rand", "litera_scaun", "clasa",
              "pret_final"],
}
UNIQUE = {
    "tara": ["id_tara", "nume_tara", "cod_iso_2"], "oras": ["id_oras", "nume_oras,id_tara"],
    "aeroport": ["id_aeroport", "cod_iata"], "avion": ["id_avion", "numar_inmatriculare"], "zbor": ["id_zbor"],
    "pasager": ["id_pasager"], "utilizator_sec": ["id_user", "email"], "utilizator_data": ["id_user"],
    "rezervare": ["id_rezervare"], "plata": ["id_plata"], "bilet": ["id_bilet"],
}
FOREIGN = {
    "oras": [("id_tara", "tara", "id_tara")],
    "aeroport": [("id_oras", "oras", "id_oras")],
    "zbor": [("id_avion", "avion", "id_avion"), ("id_aeroport_plecare", "aeroport", "id_aeroport"),
             ("id_aeroport_sosire", "aeroport", "id_aeroport")],
    "utilizator_data": [("id_user", "utilizator", "id_user")],
    "rezervare": [("id_user", "utilizator", "id_user")],
    "plata": [("id_rezervare", "rezervare", "id_rezervare")],
    "bilet": [("id_rezervare", "rezervare", "id_rezervare"), ("id_zbor", "zbor", "id_zbor"),
              ("id_pasager", "pasager", "id_pasager")],
}


def _report(site: str) -> str:
    """Every rule of a site with the number of rows that break it."""
    parity = "id_rezervare % 2 <> 0" if site == "AM" else "id_rezervare % 2 = 0"
    central = ["pasager", "utilizator_sec"] if site == "AM" else []
    names = ["tara", "oras", "aeroport", "avion", "zbor", "utilizator_data", "rezervare", "plata", "bilet", *central]
    source = {
        "utilizator_sec": "utilizator", "utilizator_data": "utilizator",
        "rezervare": f"(SELECT * FROM v_rezervare WHERE {parity})",
        "plata": f"(SELECT * FROM plata WHERE {parity})", "bilet": f"(SELECT * FROM bilet WHERE {parity})",
    }
    rows = []

    def rule(table: str, name: str, kind: str, count: str) -> None:
        stored = f"{table}_{site.lower()}" if table in ("rezervare", "plata", "bilet") else table
        rows.append(f"""SELECT '{stored}' AS "name", '{name}' AS "rule", '{kind}' kind, ({count}) violations""")

    for table in names:
        rows_of = source.get(table, table)
        for owner, name, ok in ROW_RULES:
            if (owner == table and name != "booking_region") or (owner == "utilizator" and table == "utilizator_sec"):
                rule(table, name, "check", f"SELECT count(*) FROM {rows_of} WHERE NOT ({ok})")
        for c in REQUIRED[table]:
            rule(table, f"not_null_{c}", "not_null", f"SELECT count(*) FROM {rows_of} WHERE {c} IS NULL")
        for keys in UNIQUE[table]:
            rule(table, f"unique_{keys.replace(',', '_')}", "unique",
                 f"SELECT count(*) FROM (SELECT 1 FROM {rows_of} GROUP BY {keys} HAVING count(*) > 1)")
        for fk, parent, pk in FOREIGN.get(table, []):
            if table == "utilizator_data" and site != "AM":
                continue
            kind = "fk" if site == "AM" or parent not in ("utilizator", "pasager") else "fk_site"
            rule(table, f"{kind}_{fk}", kind,
                 f"SELECT count(*) FROM {rows_of} x WHERE x.{fk} NOT IN (SELECT {pk} FROM {source.get(parent, parent)})")
    rule("rezervare", "fragment_region", "fragment",
         f"SELECT count(*) FROM {source['rezervare']} WHERE regiune_vanzare <> '{site}'")
    rule("bilet", "unique_seat_sites", "unique_site", f"""SELECT count(*) FROM {source['bilet']}
        WHERE ({_SEAT}) IN (SELECT ({_SEAT}) FROM bilet WHERE NOT ({parity}))""")
    listed = " UNION ALL ".join(rows)
    return f"SELECT *, CASE WHEN violations = 0 THEN 'OK' ELSE 'VIOLATED' END status FROM ({listed})"


sql("rule_report", _report("EU"))
sql("rule_report_master", _report("AM"))
_BATCHES = {b: f"seq <= (SELECT max(event_id) * {b} // 3 FROM events)" for b in (1, 2, 3)}
_KEPT = {
    ("value_positive", "accounts", "check"): "SELECT count(*) FROM state{0} WHERE NOT (value > 0)",
    ("unique_user_id", "accounts", "unique"):
        "SELECT count(*) FROM (SELECT 1 FROM state{0} GROUP BY user_id HAVING count(*) > 1)",
    ("unique_value_note", "accounts", "unique"):
        "SELECT count(*) FROM (SELECT 1 FROM state{0} GROUP BY value, note HAVING count(*) > 1)",
    ("fk_id_user", "bookings", "fk"):
        "SELECT count(*) FROM rezervare WHERE id_user NOT IN (SELECT user_id FROM state{0})",
}
sql("violations_after_changes", " UNION ALL ".join(
    f"""SELECT {b} batch, '{table}' AS "name", '{rule}' AS "rule", '{kind}' kind, ({count.format(b)}) violations"""
    for b in _BATCHES for (rule, table, kind), count in _KEPT.items()
), *[cte for b, until in _BATCHES.items() for cte in _state(f"state{b}", until)])
sql("refresh_validated", """SELECT 'fk_owner' AS "rule", 'rezervare' AS "name", CAST(id_rezervare AS VARCHAR) AS "key",
    CAST(id_user AS VARCHAR) detail FROM rezervare WHERE id_user NOT IN (SELECT user_id FROM after_all)""",
    *_state("after_all"))

# --- reports and listings --------------------------------------------------------------

_REPORT = (
    """recent AS (SELECT b.*, p.nationalitate FROM bilet b JOIN v_rezervare r USING (id_rezervare)
        JOIN plata a ON a.id_rezervare = r.id_rezervare JOIN pasager p ON p.id_pasager = b.id_pasager
        WHERE r.data_rezervare >= TIMESTAMP '2001-02-01 00:00:00' AND a.status = 'ACCEPTATA')""",
    """per_flight AS (SELECT id_zbor, count(id_bilet) total_bilete, sum(pret_final) venit_total
        FROM recent GROUP BY 1)""",
    """ranked AS (SELECT id_zbor, nationalitate, rank() OVER (PARTITION BY id_zbor ORDER BY count(*) DESC) rnk,
        row_number() OVER (PARTITION BY id_zbor ORDER BY count(*) DESC, nationalitate) pos
        FROM recent GROUP BY 1, 2)""",
)
_ROUTE = """SELECT id_zbor, d.cod_iata iata_plecare, s.cod_iata iata_sosire, td.nume_tara tara_plecare,
    ts.nume_tara tara_sosire, total_bilete, CAST(venit_total AS DOUBLE) venit_total,
    ((total_bilete * 20000 + capacitate) // (2 * capacitate)) / 100.0 rata_ocupare_pct,
    nationalitate nationalitate_predominanta
    FROM per_flight JOIN ranked USING (id_zbor) JOIN zbor USING (id_zbor) JOIN avion USING (id_avion)
    JOIN aeroport d ON id_aeroport_plecare = d.id_aeroport JOIN aeroport s ON id_aeroport_sosire = s.id_aeroport
    JOIN oras od ON d.id_oras = od.id_oras JOIN oras os ON s.id_oras = os.id_oras
    JOIN tara td ON od.id_tara = td.id_tara JOIN tara ts ON os.id_tara = ts.id_tara
    WHERE {0} = 1 ORDER BY per_flight.venit_total DESC, id_zbor, nationalitate LIMIT 10"""
sql("report_mode", _ROUTE.format("pos"), *_REPORT)
sql("report_rank", _ROUTE.format("rnk"), *_REPORT)
_LABEL = """nume_oras || ' (' || cod_iata || ')' AS "label" """
sql("list_departures", f"""SELECT DISTINCT id_aeroport, {_LABEL} FROM zbor
    JOIN aeroport ON id_aeroport_plecare = id_aeroport JOIN oras USING (id_oras) WHERE status = 'PROGRAMAT'""")
sql("list_arrivals", f"""SELECT DISTINCT id_aeroport, {_LABEL} FROM zbor
    JOIN aeroport ON id_aeroport_sosire = id_aeroport JOIN oras USING (id_oras)
    WHERE status = 'PROGRAMAT' AND id_aeroport_plecare = 6""")
sql("list_flights", """SELECT id_zbor, numar_zbor || ' | ' || strftime(data_plecare, '%Y-%m-%d %H:%M') AS "label",
    CAST(pret_standard AS DOUBLE) pret_standard, model FROM zbor JOIN avion USING (id_avion)
    WHERE status = 'PROGRAMAT' AND id_aeroport_plecare = 0 AND id_aeroport_sosire = 3""")
sql("latest_payments", """SELECT id_plata, id_rezervare, CAST(suma_achitata AS DOUBLE) suma_achitata, status
    FROM plata WHERE id_rezervare % 2 = 0 ORDER BY id_plata DESC LIMIT 20""")
sql("booking_history", f"""SELECT {BOOKING_COLUMNS}, nume || ' ' || prenume client
    FROM v_rezervare JOIN utilizator USING (id_user) WHERE id_rezervare % 2 = 0
    ORDER BY id_rezervare DESC LIMIT 15""")
sql("global_tickets", """SELECT id_bilet, id_rezervare, id_zbor, id_pasager, numar_rand, litera_scaun, clasa,
    CAST(pret_final AS DOUBLE) pret_final, regiune_vanzare regiune, status status_rezervare
    FROM bilet JOIN v_rezervare USING (id_rezervare)
    ORDER BY id_bilet DESC, id_rezervare, id_zbor, id_pasager, numar_rand, litera_scaun, clasa, bilet.pret_final
    LIMIT 100""")
sql("global_users", """SELECT id_user, nume, prenume, email, parola, telefon, data_inregistrare, rol
    FROM utilizator ORDER BY id_user LIMIT 50""")
sql("latest_flights", f"SELECT {FLIGHT_COLUMNS} FROM zbor ORDER BY data_plecare DESC, id_zbor LIMIT 50")
sql("active_bookings", """SELECT id_rezervare, regiune_vanzare regiune, status FROM v_rezervare
    WHERE status <> 'ANULATA' ORDER BY id_rezervare DESC LIMIT 10""")
sql("site_status", """SELECT r.id_rezervare, r.status status_rez, p.status status_plata
    FROM v_rezervare r JOIN plata p USING (id_rezervare) WHERE id_rezervare % 2 = 0""")
sql("point_lookup", f"""SELECT {FLIGHT_COLUMNS}, site FROM zbor, (VALUES ('AM'), ('EU')) s(site)
    WHERE id_zbor = 7""")
