"""The same queries as ANSI SQL over the given tables, written independently of the library.

ISBNs are checked digit by digit, dates by a format parser, latest rows by row numbers, differences by a
full join: other ways than the library's.
"""

from __future__ import annotations

from quire.functions import ACCENTS
from quire.functions.text import DAMAGE, SEARCHED_IN_NAMES
from quire.model import table
from quire.trial import catalogue as cat


def weighted(text: str, length: int) -> str:
    """Weighted digit sum of a text, weights 1 and 3 from the left."""
    return " + ".join(
        f"{1 if i % 2 == 0 else 3} * CAST(substr({text}, {i + 1}, 1) AS INTEGER)" for i in range(length)
    )


def code(day: str) -> str:
    return f"CAST(CAST(strftime({day}, '%Y%m%d') AS INTEGER) - 19000000 AS INTEGER)"


def keyed(prefix: str, key: str, width: int = 9) -> str:
    return f"'{prefix}' || lpad(CAST({key} AS VARCHAR), {width}, '0')"


def case(value: str, pairs: dict, otherwise: str) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    whens = " ".join(f"WHEN {value} = {lit(k)} THEN {lit(v)}" for k, v in pairs.items())
    return f"CASE {whens} ELSE {otherwise} END"


def big(total: str) -> str:
    return f"CAST(coalesce({total}, 0) AS BIGINT)"


def cash(total: str) -> str:
    return f"CAST(coalesce({total}, 0) AS DECIMAL(28,2))"


# Building blocks ---------------------------------------------------------------------------------

CTES = {
    "isbns": f"""
        SELECT k, isbn, ({weighted('isbn', 13)}) % 10 = 0 AS valid
        FROM (SELECT k, t || CAST(((10 - ({weighted('t', 12)}) % 10) % 10
                     + CASE WHEN k % 97 = 0 THEN 1 ELSE 0 END) % 10 AS VARCHAR) AS isbn
              FROM (SELECT p_partkey AS k, CAST(978000000000 + p_partkey AS VARCHAR) AS t FROM part))""",
    "sales": """
        SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS num_mouvement, isbn, valid,
               CAST(l_shipdate AS DATE) AS date_vente,
               CAST(sgn * CAST(l_quantity AS INTEGER) AS INTEGER) AS quantite,
               CAST(sgn * ht AS DECIMAL(11,2)) AS montant_ht,
               CAST(sgn * CAST(ht * (1 + CAST(l_tax AS DECIMAL(5,2))) AS DECIMAL(11,2)) AS DECIMAL(11,2)) AS montant_ttc,
               CASE l_linenumber WHEN 1 THEN 'LIB' WHEN 2 THEN 'GMS' WHEN 3 THEN 'WEB' WHEN 4 THEN 'EXP'
                    WHEN 5 THEN 'CLB' ELSE 'XXX' END AS canal,
               'P' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS code_client,
               'W' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS code_entrepot,
               CASE WHEN l_returnflag = 'N' THEN CAST(l_shipdate AS DATE) + 31 END AS date_reglement,
               CASE l_returnflag WHEN 'N' THEN 'V' ELSE l_returnflag END AS vestat,
               CASE l_returnflag WHEN 'N' THEN 'Vente' WHEN 'R' THEN 'Retour' WHEN 'A' THEN 'Avoir'
                    ELSE 'Inconnu' END AS type_mouvement
        FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS sgn,
                     CAST(l_extendedprice AS DECIMAL(11,2)) AS ht
              FROM lineitem JOIN isbns ON l_partkey = k)""",
    "good_sales": "SELECT *, year(date_vente) AS y, month(date_vente) AS m FROM sales WHERE valid",
    "books": f"""
        SELECT isbn, trim(p_name) AS titre, CAST(NULL AS VARCHAR) AS sous_titre,
               {keyed('S', "regexp_extract(p_brand, '([0-9]+)', 1)")} AS code_editeur,
               'C' || regexp_extract(p_brand, '([0-9]+)', 1) || substr(p_type, 1, 3) AS code_collection,
               CASE p_type WHEN 'STANDARD' THEN 'GFT' WHEN 'SMALL' THEN 'POC' WHEN 'MEDIUM' THEN 'NUM'
                    WHEN 'LARGE' THEN 'AUD' WHEN 'PROMO' THEN 'BDA' ELSE 'ECO' END AS format,
               CASE p_type WHEN 'STANDARD' THEN 'Grand format' WHEN 'SMALL' THEN 'Poche'
                    WHEN 'MEDIUM' THEN 'Numérique' WHEN 'LARGE' THEN 'Audio' WHEN 'PROMO' THEN 'BD / Album'
                    ELSE 'Autre' END AS libelle_format,
               'FRE' AS langue, p_size * 10 AS nb_pages, ht AS prix_ht,
               CAST(ht * 1.055 AS DECIMAL(9,2)) AS prix_ttc, CAST(5.50 AS DECIMAL(5,2)) AS taux_tva,
               CASE WHEN k % 211 = 0 OR k % 503 = 0 THEN NULL
                    ELSE DATE '1960-01-01' + CAST(k * 7 % 25000 AS INTEGER) END AS date_publication,
               CASE p_size % 5 WHEN 0 THEN 'AC' WHEN 1 THEN 'EP' WHEN 2 THEN 'AN' WHEN 3 THEN 'PI' ELSE 'RS' END AS statut,
               CASE p_size % 5 WHEN 0 THEN 'Actif' WHEN 1 THEN 'Épuisé' WHEN 2 THEN 'Annoncé'
                    WHEN 3 THEN 'Pilonné' ELSE 'Autre' END AS libelle_statut,
               p_size * 1000 AS tirage_initial, p_size * 20 AS poids_grammes, p_brand AS commentaire, valid
        FROM (SELECT *, CAST((CAST(p_retailprice AS DECIMAL(9,2)) - 900) / 3 AS DECIMAL(9,2)) AS ht
              FROM part JOIN isbns ON p_partkey = k)""",
    "authors": f"""
        SELECT {keyed('A', 'c_custkey')} AS code_auteur, trim(c_name) AS nom, c_mktsegment AS prenom,
               CASE WHEN bal < 1000 THEN '' WHEN bal > 9000 THEN 'Plume ' || CAST(c_custkey AS VARCHAR) END AS pseudonyme,
               CASE WHEN bal > 9000 THEN 'Plume ' || CAST(c_custkey AS VARCHAR)
                    ELSE c_mktsegment || ' ' || c_name END AS nom_complet,
               'N' || CAST(c_nationkey AS VARCHAR) AS nationalite,
               DATE '1930-01-01' + CAST(c_custkey * 11 % 20000 AS INTEGER) AS date_naissance,
               CASE WHEN bal > 5000 THEN DATE '1995-01-01' + CAST(c_custkey * 3 % 9000 AS INTEGER) END AS date_deces,
               NOT (bal > 5000) AS est_vivant,
               CASE WHEN bal > 0 THEN 'A' ELSE 'I' END AS statut
        FROM (SELECT *, CAST(c_acctbal AS DECIMAL(11,2)) AS bal FROM customer)""",
    "publishers": f"""
        SELECT {keyed('S', 's_suppkey')} AS code_editeur, s_name AS nom_editeur, s_name AS imprint,
               'G' || CAST(s_nationkey AS VARCHAR) AS groupe, lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS pays,
               CAST(s_acctbal AS DECIMAL(11,2)) > 1000 AS active
        FROM supplier""",
    "bridge": f"""
        SELECT isbn, {keyed('A', 'o_custkey')} AS code_auteur, role, ordre
        FROM (SELECT l_partkey, o_custkey,
                     CASE o_orderpriority WHEN '1-URGENT' THEN 'AUT' WHEN '2-HIGH' THEN 'TRA'
                          WHEN '3-MEDIUM' THEN 'ILL' WHEN '4-NOT SPECIFIED' THEN 'PRE' WHEN '5-LOW' THEN 'AUT'
                          ELSE 'XXX' END AS role, min(l_linenumber) AS ordre
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
        JOIN isbns ON l_partkey = k""",
    "wrote": "SELECT DISTINCT isbn, code_auteur FROM bridge WHERE role = 'AUT'",
    "stock": f"""
        SELECT isbn, valid, {keyed('W', 'l_suppkey')} AS code_entrepot, CAST(l_shipdate AS DATE) AS date_position,
               CAST(l_quantity AS INTEGER) AS qte_disponible, l_linenumber AS qte_reservee,
               nullif(CAST(CAST(l_discount AS DECIMAL(5,2)) * 100 AS INTEGER), 0) AS qte_transit,
               CAST(CAST(l_tax AS DECIMAL(5,2)) * 100 AS INTEGER) AS qte_pilonnee
        FROM lineitem JOIN isbns ON l_partkey = k""",
    "line_totals": """
        SELECT l_orderkey, min(l_partkey) AS part, sum(CAST(l_quantity AS INTEGER)) AS ordered,
               sum(CAST(l_quantity AS INTEGER)) FILTER (l_linestatus = 'F') AS sent,
               max(CAST(l_shipdate AS DATE)) FILTER (l_linestatus = 'F') AS last_sent
        FROM lineitem GROUP BY l_orderkey""",
    "cmd": f"""
        SELECT o_orderkey AS num_commande, isbn, CAST(o_orderdate AS DATE) AS date_commande,
               last_sent AS date_livraison, CAST(ordered AS INTEGER) AS qte_commandee,
               CAST(sent AS INTEGER) AS qte_livree, CAST(o_totalprice AS DECIMAL(11,2)) AS montant_ht,
               {keyed('A', 'o_custkey')} AS code_client,
               CASE o_orderstatus WHEN 'F' THEN 'LV' WHEN 'O' THEN 'EN' WHEN 'P' THEN 'PA' ELSE 'XXX' END AS statut
        FROM orders LEFT JOIN line_totals ON o_orderkey = l_orderkey LEFT JOIN isbns ON part = k""",
    "contracts": f"""
        SELECT o_orderkey AS num_contrat, {keyed('A', 'o_custkey')} AS code_auteur,
               CASE WHEN o_orderpriority <> '5-LOW' THEN isbn END AS isbn,
               CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 8 WHEN '2-HIGH' THEN 12 WHEN '3-MEDIUM' THEN 10
                    WHEN '4-NOT SPECIFIED' THEN 6 WHEN '5-LOW' THEN 3 ELSE 0 END AS DECIMAL(5,2)) AS pct,
               CAST(CAST(o_totalprice AS DECIMAL(11,2)) * 0.01 AS DECIMAL(11,2)) AS avance,
               CAST(o_orderdate AS DATE) AS date_debut,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 1000 END AS date_fin
        FROM orders LEFT JOIN line_totals ON o_orderkey = l_orderkey LEFT JOIN isbns ON part = k""",
    "priced": """
        SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(11,2)) AS o_totalprice,
               CAST(o_orderdate AS DATE) AS o_orderdate FROM orders""",
    "log": """
        SELECT event_type AS table_name, ts AS loaded_at,
               CAST(trunc(CAST(value AS DECIMAL(18,2))) AS BIGINT) AS row_count FROM events""",
}


def with_(names: str, body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in names.split()) + "\n" + body


# Shared pieces -----------------------------------------------------------------------------------

RAW_SALES = with_("isbns sales", f"""
    SELECT num_mouvement AS VENUMR, isbn AS VEISBN, {code('date_vente')} AS VEDTVT, quantite AS VEQTE,
           montant_ht AS VEMTHT, montant_ttc AS VEMTTTC, canal AS VECANL, code_client || '   ' AS VECLIE,
           code_entrepot AS VEENTR, {code('date_reglement')} AS VEDTRG, vestat AS VESTAT FROM sales""")

FACT_COLUMNS = """num_mouvement, isbn, date_vente, CAST(y AS INTEGER) AS annee_vente,
    CAST(m AS INTEGER) AS mois_vente, quantite, montant_ht, montant_ttc, canal, code_client, code_entrepot,
    date_reglement, type_mouvement"""
FACT_SALES = with_("isbns sales good_sales", f"SELECT {FACT_COLUMNS} FROM good_sales")

SALE_SUMS = f"{big('sum(quantite)')} AS quantite, {cash('sum(montant_ttc)')} AS montant_ttc"

MEASURE = "DECIMAL(18,6)"


def pct(part: str, whole: str) -> str:
    return f"coalesce(CAST({part} AS DOUBLE) * 100 / nullif(CAST({whole} AS DOUBLE), 0), 0)"


def gate_row(check: str, status: str, measured: str, threshold: float, detail: str) -> str:
    return (f"{check} AS \"check\", {status} AS status, CAST({measured} AS {MEASURE}) AS measured, "
            f"CAST({threshold} AS {MEASURE}) AS threshold, {detail} AS detail")


def told(*parts: tuple[str, str]) -> str:
    return " || ' ' || ".join(f"'{name}=' || CAST({value} AS VARCHAR)" for name, value in parts)


def profile(column: str, place: int, kind: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"""SELECT 'CMDEP' AS table_name, {place} AS ordinal, '{column}' AS column_name, '{kind}' AS column_type,
        count(*) AS row_count, count(*) - count({column}) AS null_count,
        CAST(min({column}) AS VARCHAR) AS min_value, CAST(max({column}) AS VARCHAR) AS max_value,
        CAST(max(length({text})) AS INTEGER) AS max_length FROM raw_cmd"""


RAW_ORDERS = f"""SELECT num_commande AS CMNUMR, isbn AS CMISBN, {code('date_commande')} AS CMDTCM,
    {code('date_livraison')} AS CMDTLV, qte_commandee AS CMQTE, qte_livree AS CMQTLV, montant_ht AS CMMTHT,
    code_client AS CMCLIE, statut AS CMSTAT FROM cmd"""

COUNT_SOURCES = {
    "ouvrages": ("OUVRGP", "part"), "auteurs": ("AUTURP", "customer"), "editeurs": ("EDITRP", "supplier"),
    "ventes": ("VENTEP", "lineitem"),
    "commandes": ("CMDEP", "orders"),
    "stocks": ("STCKP", "lineitem"),
    "contrats": ("CNTRTP", "orders"),
}

LATEST_SALES = """
    SELECT * EXCLUDE (place) FROM (
        SELECT *, row_number() OVER (PARTITION BY num_mouvement ORDER BY date_vente DESC NULLS LAST,
            isbn DESC NULLS LAST, quantite DESC NULLS LAST, montant_ht DESC NULLS LAST, montant_ttc DESC NULLS LAST,
            canal DESC NULLS LAST, code_client DESC NULLS LAST, code_entrepot DESC NULLS LAST,
            date_reglement DESC NULLS LAST, {last} DESC NULLS LAST) AS place FROM sales) WHERE place = 1"""

SILVER_SALES_COLUMNS = """num_mouvement, isbn, date_vente, quantite, montant_ht, montant_ttc, canal, code_client,
    code_entrepot, date_reglement, type_mouvement, valid AS isbn_valide"""

HELD = " UNION ALL ".join(
    f"SELECT 'documents' AS table_name, '{c}' AS \"character\", '{meaning}' AS meaning, "
    f"{str(c in DAMAGE).lower()} AS is_damage, count(*) FILTER (contains(text, '{c}')) AS row_count FROM documents"
    for c, meaning in {**ACCENTS, **DAMAGE}.items()
)

LAYER_COUNTS = """
    SELECT 'ouvrages' AS name, false AS by_design, (SELECT count(*) FROM part) AS b,
           (SELECT count(*) FROM part) AS s, (SELECT count(*) FROM isbns WHERE valid) AS g
    UNION ALL SELECT 'ventes', true, (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem),
           (SELECT count(*) FROM good_sales)
    UNION ALL SELECT 'stocks', false, (SELECT count(*) FROM lineitem), (SELECT count(*) FROM lineitem),
           (SELECT count(*) FROM good_sales)
    UNION ALL SELECT 'editeurs', false, (SELECT count(*) FROM supplier), (SELECT count(*) FROM supplier),
           (SELECT count(*) FROM publishers WHERE active)
    UNION ALL SELECT 'auteurs', false, (SELECT count(*) FROM customer), (SELECT count(*) FROM customer),
           (SELECT count(*) FROM customer)"""

COMPLETENESS = "SELECT " + gate_row(
    "'completeness ' || name",
    f"CASE WHEN {pct('b - s', 'b')} > 1.0 THEN 'FAIL' WHEN {pct('s - g', 's')} > 1.0 AND NOT by_design THEN 'WARN' ELSE 'PASS' END",
    f"greatest({pct('b - s', 'b')}, {pct('s - g', 's')})", 1.0,
    told(("bronze", "b"), ("silver", "s"), ("gold", "g")),
) + f" FROM ({LAYER_COUNTS})"


def isbn_gate(name: str, table: str, limit: float) -> str:
    rate = pct("bad", "n")
    return "SELECT " + gate_row(
        f"'isbn checksum {name}'", f"CASE WHEN {rate} > {limit} THEN 'FAIL' WHEN bad > 0 THEN 'WARN' ELSE 'PASS' END",
        rate, limit, told(("invalid", "bad"), ("rows", "n")),
    ) + f" FROM (SELECT count(*) FILTER (NOT valid) AS bad, count(*) AS n FROM {table})"


def date_gates(name: str, table: str, column: str) -> str:
    rate = pct("nulls", "n")
    source = f"""(SELECT count(*) AS n, count(*) FILTER ({column} IS NULL) AS nulls,
        count(*) FILTER (year({column}) NOT BETWEEN 1900 AND 2030) AS outside FROM {table})"""
    return (
        "SELECT " + gate_row(f"'date range {name}.{column}'", "CASE WHEN outside > 0 THEN 'FAIL' ELSE 'PASS' END",
                             "outside", 0, told(("outside", "outside"), ("rows", "n"))) + f" FROM {source}"
        " UNION ALL SELECT " + gate_row(f"'date nulls {name}.{column}'", f"CASE WHEN {rate} > 2.0 THEN 'WARN' ELSE 'PASS' END",
                                        rate, 2.0, told(("nulls", "nulls"), ("rows", "n"))) + f" FROM {source}"
    )


AMOUNT_TOTALS = """(SELECT (SELECT sum(montant_ttc) FROM sales) AS b, (SELECT sum(montant_ttc) FROM sales) AS s,
    (SELECT sum(montant_ttc) FROM good_sales) AS g, (SELECT coalesce(sum(montant_ttc), 0) FROM sales WHERE NOT valid) AS x)"""

AMOUNT_GATES = (
    "SELECT " + gate_row("'amounts bronze to silver'", "CASE WHEN abs(b - s) > 0 THEN 'FAIL' ELSE 'PASS' END",
                         pct("abs(b - s)", "abs(b)"), 0.01, told(("bronze", "b"), ("silver", "s")))
    + f" FROM {AMOUNT_TOTALS} UNION ALL SELECT "
    + gate_row("'amounts silver to gold'", "CASE WHEN abs(s - g - x) > 0 THEN 'FAIL' ELSE 'PASS' END",
               "abs(s - g - x)", 0, told(("silver", "s"), ("gold", "g"), ("excluded", "x")))
    + f" FROM {AMOUNT_TOTALS}"
)


def integrity_gate(check: str, orphans: str) -> str:
    return "SELECT " + gate_row(
        f"'{check}'", "CASE WHEN rows_lost > 0 THEN 'WARN' ELSE 'PASS' END", "rows_lost", 0,
        told(("orphan rows", "rows_lost"), ("keys", "keys_lost")),
    ) + f" FROM (SELECT count(*) AS rows_lost, count(DISTINCT k) AS keys_lost FROM ({orphans}))"


def null_gates(name: str, table: str, columns: list[str]) -> str:
    rows = []
    for c in columns:
        source = f"(SELECT count(*) - count({c}) AS nulls, count(*) AS n FROM {table})"
        rate = pct("nulls", "n")
        label = "isbn_valide" if c == "valid" else c
        rows.append("SELECT " + gate_row(
            f"'nulls {name}.{label}'", f"CASE WHEN {rate} > 20 THEN 'FAIL' WHEN {rate} > 5 THEN 'WARN' ELSE 'PASS' END",
            rate, 5.0, told(("nulls", "nulls"), ("rows", "n"))) + f" FROM {source}")
    return " UNION ALL ".join(rows)


def expected_gate(check: str, where: str, holds: str) -> str:
    return "SELECT " + gate_row(
        f"'{check}'", "CASE WHEN n > 0 AND n = good THEN 'PASS' ELSE 'FAIL' END", "n - good", 0,
        told(("rows", "n"), ("as expected", "good")),
    ) + f" FROM (SELECT count(*) FILTER ({where}) AS n, count(*) FILTER (({where}) AND ({holds})) AS good FROM books)"


ACCENT_GATE = "SELECT " + gate_row(
    "'accents'", "CASE WHEN good > 0 AND bad = 0 THEN 'PASS' ELSE 'WARN' END", "good", 1,
    told(("characters", "good"), ("damaged rows", "bad")),
) + """ FROM (SELECT count(*) FILTER (NOT is_damage AND row_count > 0) AS good,
        CAST(coalesce(sum(row_count) FILTER (is_damage), 0) AS BIGINT) AS bad FROM ({held}))"""


def name_held() -> str:
    """The audited characters in author names and book titles."""
    return " UNION ALL ".join(
        f"SELECT {str(c in DAMAGE).lower()} AS is_damage, (SELECT count(*) FROM authors WHERE contains(concat_ws(' ', nom, prenom), '{c}'))"
        f" + (SELECT count(*) FROM books WHERE contains(titre, '{c}')) AS row_count"
        for c in {**ACCENTS, **DAMAGE}
    )


def orphan_sql(child: str, key: str, known: str) -> str:
    return f"SELECT {key} AS k FROM {child} WHERE {key} IS NULL OR {key} NOT IN (SELECT kk FROM ({known}) WHERE kk IS NOT NULL)"


NULL_GATES = null_gates(
    "auteurs", "authors",
    ["code_auteur", "nom", "prenom", "pseudonyme", "nationalite", "date_naissance", "date_deces",
     "CAST(DATE '2020-01-01' AS DATE)", "statut"],
).replace("auteurs.CAST(DATE '2020-01-01' AS DATE)", "auteurs.date_creation_fiche") + " UNION ALL " + null_gates(
    "ventes", "sales",
    ["num_mouvement", "isbn", "date_vente", "quantite", "montant_ht", "montant_ttc", "canal", "code_client",
     "code_entrepot", "date_reglement", "type_mouvement", "valid"],
)


def isbn_shape_gate(limit: float) -> str:
    return "SELECT " + gate_row(
        "'isbn shape ventes'", f"CASE WHEN {pct('bad', 'n')} > {limit} THEN 'FAIL' ELSE 'PASS' END", pct("bad", "n"), limit,
        told(("invalid", "bad"), ("rows", "n")),
    ) + " FROM (SELECT count(*) FILTER (NOT regexp_full_match(isbn, '97[89][0-9]{10}')) AS bad, count(*) AS n FROM sales)"


NO_ROW_LOST = "SELECT " + gate_row(
    "'row_loss ventes'", "'PASS'", "0", 1.0, told(("bronze", "n"), ("silver", "n")),
) + " FROM (SELECT count(*) AS n FROM lineitem)"

GATE_PARTS = " UNION ALL ".join([
    COMPLETENESS,
    NO_ROW_LOST,
    NULL_GATES,
    isbn_shape_gate(5.0),
    isbn_gate("ouvrages", "books", 5.0),
    date_gates("ouvrages", "books", "date_publication"),
    AMOUNT_GATES,
    ACCENT_GATE.format(held=name_held()),
    integrity_gate("fk ventes to ouvrages", orphan_sql("sales", "isbn", "SELECT isbn AS kk FROM books")),
    integrity_gate("fk ouvrages to editeurs", orphan_sql("books", "code_editeur", "SELECT code_editeur AS kk FROM publishers")),
])

ISBN10 = """
    SELECT p_partkey, body || CASE WHEN chk = 10 THEN 'X' ELSE CAST(chk AS VARCHAR) END AS isbn10,
           p_partkey % 97 <> 0 AS good
    FROM (SELECT p_partkey, body, CASE WHEN p_partkey % 97 = 0 THEN (c + 1) % 11 ELSE c END AS chk
          FROM (SELECT p_partkey, body, (11 - ({sums}) % 11) % 11 AS c
                FROM (SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS body FROM part)))""".format(
    sums=" + ".join(f"{10 - i} * CAST(substr(body, {i + 1}, 1) AS INTEGER)" for i in range(9))
)

# The queries -------------------------------------------------------------------------------------

ORACLE: dict[str, str] = {
    "bronze_typed": RAW_SALES,
    "csv_bronze_roundtrip": RAW_SALES,
    "bronze_copy": "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders",
    "extract_orders": with_("isbns line_totals cmd", RAW_ORDERS),
    "extract_authors": f"""
        SELECT {keyed('A', 'c_custkey')} AS AUCODE, rpad(c_name, 30, ' ') AS AUNOM, rpad(c_mktsegment, 20, ' ') AS AUPRN,
               CASE WHEN bal < 1000 THEN '          ' WHEN bal > 9000 THEN 'Plume ' || CAST(c_custkey AS VARCHAR) || '   ' END AS AUPSEUD,
               'N' || CAST(c_nationkey AS VARCHAR) AS AUNATI,
               {code("DATE '1930-01-01' + CAST(c_custkey * 11 % 20000 AS INTEGER)")} AS AUDTNS,
               CASE WHEN bal > 5000 THEN {code("DATE '1995-01-01' + CAST(c_custkey * 3 % 9000 AS INTEGER)")} END AS AUDTDC,
               CAST(NULL AS VARCHAR) AS AUEMAIL, 1200101 AS AUDTCR, CASE WHEN bal > 0 THEN 'A' ELSE 'I' END AS AUSTAT
        FROM (SELECT *, CAST(c_acctbal AS DECIMAL(11,2)) AS bal FROM customer)""",
    "extract_publishers": f"""
        SELECT {keyed('S', 's_suppkey')} AS EDCODE, rpad(s_name, 40, ' ') AS EDNOM, rpad(s_name, 40, ' ') AS EDIMPR,
               'G' || CAST(s_nationkey AS VARCHAR) AS EDGRPE, lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS EDPAYS,
               CASE WHEN CAST(s_acctbal AS DECIMAL(11,2)) > 1000 THEN 'A' ELSE 'I' END AS EDSTAT FROM supplier""",
    "extract_contracts": with_("isbns line_totals contracts", f"""
        SELECT num_contrat AS CTNUM, code_auteur AS CTAUTE, isbn AS CTISBN, 'CES' AS CTTYPE, pct AS CTPCTD,
               avance AS CTAVNC, {code('date_debut')} AS CTDTDB, {code('date_fin')} AS CTDTFN,
               CASE WHEN date_fin IS NOT NULL THEN 'T' ELSE 'A' END AS CTSTAT FROM contracts"""),
    "sorted_load": with_("priced", "SELECT * FROM priced"),
    "overwrite_new_schema": with_("priced", "SELECT * FROM priced"),
    "partitioned_write": with_("priced", "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM priced"),
    "drop_folder_load": with_("isbns line_totals cmd", RAW_ORDERS),
    "json_report_roundtrip": with_("isbns sales good_sales", AMOUNT_GATES),
    "xml_products": with_("isbns", """
        SELECT isbn AS reference, isbn AS isbn13, lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS isbn10, p_name AS titre
        FROM part JOIN isbns ON p_partkey = k"""),
    "iso_dates": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS o_day FROM orders""",
    "incremental_pipeline_counts": with_("priced", f"""
        SELECT o_orderstatus, count(*) AS nb_commandes, {cash('sum(o_totalprice)')} AS montant FROM priced GROUP BY 1"""),
    "layout_proof": with_("isbns sales good_sales", """
        SELECT count(*) AS row_count, count(*) AS plain_row_count, true AS reads_fewer FROM good_sales"""),
    "layout_report": """
        SELECT true AS in_files, count(*) AS row_count FROM lineitem
        WHERE l_shipdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31'""",
    "extract_books": with_("isbns books", """
        SELECT isbn AS OVISBN, rpad(titre, 40, ' ') AS OVTITR, sous_titre AS OVSTIT, code_editeur AS OVEDIT, code_collection AS OVCOLL,
               format AS OVFMT, langue AS OVLANG, nb_pages AS OVNBPG, prix_ht AS OVPXHT, prix_ttc AS OVPXTTC, taux_tva AS OVTVA,
               CASE WHEN raw % 211 = 0 THEN 0 WHEN raw % 503 = 0 THEN 1251301
                    ELSE CAST(CAST(strftime(date_publication, '%Y%m%d') AS INTEGER) - 19000000 AS INTEGER) END AS OVDTPB,
               1200101 AS OVDTCR, 1250101 AS OVDTMJ, statut AS OVSTAT, tirage_initial AS OVTIRG, poids_grammes AS OVPOID,
               isbn AS OVEAN, commentaire AS OVCOMM
        FROM (SELECT *, CAST(substr(isbn, 1, 12) AS BIGINT) - 978000000000 AS raw FROM books)"""),
    "observed_unreadable": " UNION ALL ".join(
        "SELECT " + gate_row(
            f"'unreadable ouvrages.{f.source}'", f"CASE WHEN bad = 0 THEN 'PASS' ELSE '{'WARN' if f.kind == 'cyymmdd' else 'FAIL'}' END",
            "bad", 0, told(("unreadable", "bad"), ("rows", "n")))
        + f" FROM (SELECT count(*) FILTER ({'p_partkey % 503 = 0 AND p_partkey % 211 <> 0' if f.source == 'OVDTPB' else 'p_size = 1' if f.source == 'OVPXHT' else 'false'}) AS bad,"
        " count(*) AS n FROM part)"
        for f in table("ouvrages").fields if f.kind != "char"),
    "incremental_runs": with_("isbns sales", f"""
        SELECT {FACT_COLUMNS} FROM (SELECT *, year(date_vente) AS y, month(date_vente) AS m
            FROM ({LATEST_SALES.format(last='vestat')}) WHERE valid)"""),
    "sliced_extraction": RAW_SALES,
    "merged_sketches": "SELECT column_name, (SELECT count(*) FROM lineitem) AS row_count, true AS within_bound FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS column_name" for c in ("VEISBN", "VENUMR", "VEDTVT", "VECANL", "VEENTR")) + ")",
    "evolved_deliveries": with_("priced", """
        SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderdate, CAST(o_totalprice AS DECIMAL(14,3)) AS o_totalprice,
               CASE WHEN o_orderstatus = 'P' THEN 'P' END AS o_orderstatus FROM priced"""),
    "quarantined_lines": with_("isbns line_totals cmd", f"""
        SELECT CAST(count(*) AS BIGINT) AS lines, CAST(count(*) FILTER (num_commande % 10 <> 3) AS BIGINT) AS accepted,
               CAST(count(*) FILTER (num_commande % 10 = 3) AS BIGINT) AS rejected, true AS balanced,
               {cash('sum(montant_ht) FILTER (num_commande % 10 <> 3)')} AS montant_ht FROM cmd"""),
    "drill_down_orders": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 997 = 5 THEN 'deleted' ELSE 'updated' END AS change
        FROM orders WHERE o_orderkey % 997 = 5 OR o_orderkey % 1009 = 7""",
    "onix_arrivals": with_("isbns", """
        SELECT isbn AS reference, isbn AS isbn13, CASE WHEN p_partkey % 4 >= 2 THEN p_name ELSE p_type END AS titre, CAST(1 AS BIGINT) AS files_set_aside
        FROM part JOIN isbns ON p_partkey = k"""),
    "author_contracts": with_("authors isbns line_totals contracts", """
        SELECT a.code_auteur, any_value(a.nom_complet) AS nom_complet, count(num_contrat) AS nb_contrats,
               count(*) FILTER (date_debut <= DATE '{end}' AND (date_fin IS NULL OR date_fin >= DATE '{end}')) AS nb_contrats_en_cours,
               min(pct) AS pct_droits_min, max(pct) AS pct_droits_max, CAST(coalesce(sum(avance), 0) AS DECIMAL(28,2)) AS total_avances,
               min(date_debut) AS premier_contrat
        FROM authors a LEFT JOIN contracts c ON a.code_auteur = c.code_auteur GROUP BY a.code_auteur""".replace("{end}", str(cat.FIRST_LOAD_END))),
    "orders_with_publisher": with_("isbns books line_totals cmd", """
        SELECT num_commande, date_commande, code_editeur, qte_commandee, montant_ht
        FROM cmd LEFT JOIN (SELECT isbn, code_editeur FROM books WHERE valid) b ON cmd.isbn = b.isbn"""),
    "sketches_within_bound": "SELECT column_name, (SELECT count(*) FROM lineitem) AS row_count, true AS within_bound FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS column_name" for c in table("ventes").source_columns) + ")",
    "incremental_since": f"""
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus FROM orders
        WHERE o_orderdate IS NULL OR o_orderdate >= (SELECT date_trunc('day', max(o_orderdate)) FROM orders WHERE o_orderdate < DATE '{cat.FIRST_LOAD_END}')""",
    "upsert_by_key": with_("priced", f"""
        , batch AS (SELECT * REPLACE ('X' AS o_orderstatus) FROM priced WHERE o_orderdate >= DATE '{cat.SECOND_LOAD_START}')
        SELECT * FROM batch UNION ALL
        SELECT * FROM priced WHERE o_orderdate < DATE '{cat.FIRST_LOAD_END}'
            AND o_orderkey NOT IN (SELECT o_orderkey FROM batch)"""),
    "snapshot_diff_orders": with_("priced", f"""
        , a AS (SELECT * FROM priced WHERE o_orderdate < DATE '{cat.SNAPSHOT_TO}'),
          b AS (SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' AND o_totalprice > 100000 THEN NULL
                                  ELSE o_orderstatus END AS o_orderstatus)
                FROM priced WHERE o_orderdate >= DATE '{cat.SNAPSHOT_FROM}')
        SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
               CASE WHEN a.o_orderkey IS NULL THEN 'inserted' WHEN b.o_orderkey IS NULL THEN 'deleted'
                    WHEN a.o_custkey IS NOT DISTINCT FROM b.o_custkey
                     AND a.o_orderstatus IS NOT DISTINCT FROM b.o_orderstatus
                     AND a.o_totalprice IS NOT DISTINCT FROM b.o_totalprice
                     AND a.o_orderdate IS NOT DISTINCT FROM b.o_orderdate THEN 'unchanged'
                    ELSE 'updated' END AS change
        FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey"""),
    "slice_counts_by_year": with_("isbns sales", """
        SELECT CAST(year(date_vente) AS INTEGER) AS annee, code_entrepot, count(*) AS row_count
        FROM sales GROUP BY ALL"""),
    "union_evolved_schema": """
        SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
        FROM orders WHERE o_orderstatus IS NOT NULL""",
    "bronze_manifest": " UNION ALL ".join(
        f"SELECT 'bronze_{n}' AS table_name, '{src}' AS source_name, count(*) AS row_count, "
        f"{str(n == 'ventes').lower()} AS is_blu_source, TIMESTAMP '{cat.EXTRACTED_AT}' AS extracted_at, 'OK' AS status FROM {given}"
        for n, (src, given) in COUNT_SOURCES.items()
    ),
    "observed_manifest": " UNION ALL ".join(
        f"SELECT 'bronze_{n}' AS table_name, '{src}' AS source_name, count(*) AS row_count, "
        f"{str(n == 'ventes').lower()} AS is_blu_source, TIMESTAMP '{cat.EXTRACTED_AT}' AS extracted_at, 'OK' AS status FROM {given}"
        for n, (src, given) in COUNT_SOURCES.items()
    ),
    "table_inventory": " UNION ALL ".join(
        f"SELECT '{src}' AS table_name, '{'COLUMN' if src == 'VENTEP' else 'ROW'}' AS storage, "
        f"(SELECT count(*) FROM {given}) AS row_count, {i} AS ordinal, '{f.source}' AS column_name, "
        f"'{'CHAR' if f.kind == 'char' else 'DECIMAL'}' AS column_type, {f.length} AS \"length\", {f.scale} AS scale, "
        f"{str(not f.required).lower()} AS nullable, {297 if f.kind == 'char' else 0} AS ccsid, "
        f"'{'STRING' if f.kind == 'char' else f'DECIMAL({f.length},{f.scale})'}' AS spark_type"
        for n, (src, given) in COUNT_SOURCES.items() for i, f in enumerate(table(n).fields, 1)
    ),
    "column_profile": with_("isbns line_totals cmd", f", raw_cmd AS ({RAW_ORDERS}) " + " UNION ALL ".join(
        profile(c, i + 1, k) for i, (c, k) in enumerate([
            ("CMNUMR", "bigint"), ("CMISBN", "string"), ("CMDTCM", "int"), ("CMDTLV", "int"), ("CMQTE", "int"),
            ("CMQTLV", "int"), ("CMMTHT", "decimal(11,2)"), ("CMCLIE", "string"), ("CMSTAT", "string")])
    )),
    "trim_fixed_width": with_("authors", """
        SELECT code_auteur, nom, pseudonyme, 60 AS largeur_nom FROM authors"""),
    "cyymmdd_to_date_lines": f"""
        SELECT code, CAST(try_strptime(CAST(code + 19000000 AS VARCHAR), '%Y%m%d') AS DATE) AS decoded, count(*) AS row_count
        FROM (SELECT CAST(CASE l_linenumber WHEN 7 THEN c + 1200 WHEN 6 THEN 0 ELSE c END AS INTEGER) AS code
              FROM (SELECT l_linenumber, {code('l_shipdate')} AS c FROM lineitem))
        GROUP BY ALL""",
    "date_to_cyymmdd_orders": f"SELECT o_orderkey, {code('o_orderdate')} AS code FROM orders",
    "typed_amounts": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(11,2)) END AS montant,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rang,
               TRY_CAST(substr(o_orderpriority, 1, 3) AS INTEGER) IS NULL AS illisible FROM orders""",
    "metadata_cast": """
        SELECT p_partkey, p_name, CAST(p_size AS SMALLINT) AS p_size,
               CAST(p_retailprice AS DECIMAL(9,2)) AS p_retailprice, p_type FROM part""",
    "metadata_clean": with_("isbns sales", f"""
        SELECT CAST(num_mouvement AS DECIMAL(15,0)) AS venumr, isbn AS veisbn, date_vente AS vedtvt,
               CAST(quantite AS DECIMAL(9,0)) AS veqte, montant_ht AS vemtht, montant_ttc AS vemtttc, canal AS vecanl,
               code_client AS veclie, code_entrepot AS veentr, date_reglement AS vedtrg, vestat
        FROM ({LATEST_SALES.format(last='vestat')})"""),
    "strip_control_chars": """
        SELECT doc_id, CAST(length(t) AS INTEGER) AS nb_caracteres,
               CAST(length(text) - length(t) AS INTEGER) AS nb_retires, md5(t) AS empreinte
        FROM (SELECT doc_id, text, regexp_replace(text, '[\\x00-\\x1f]', '', 'g') AS t FROM documents)""",
    "movement_type": with_("isbns sales", """
        SELECT vestat AS VESTAT, type_mouvement, count(*) AS row_count FROM sales GROUP BY ALL"""),
    "format_status_label": with_("isbns books", "SELECT isbn, libelle_format, libelle_statut FROM books"),
    "price_band_books": with_("isbns books", """
        SELECT isbn, prix_ttc, CASE WHEN statut = 'AN' THEN NULL WHEN prix_ttc < 10 THEN '< 10 €'
               WHEN prix_ttc < 20 THEN '10-20 €' WHEN prix_ttc < 30 THEN '20-30 €' ELSE '≥ 30 €' END AS tranche_prix
        FROM books"""),
    "isbn13_valid_sales": with_("isbns", """
        SELECT isbn, valid AS isbn_valide, count(*) AS row_count
        FROM lineitem JOIN isbns ON l_partkey = k GROUP BY ALL"""),
    "isbn13_shape": with_("isbns", f"""
        SELECT p_partkey, coalesce(regexp_full_match(w, '97[89][0-9]{{10}}'), false) AS bonne_forme,
               coalesce(length(trim(w)) = 13 AND ({weighted('trim(w)', 13)}) % 10 = 0, false) AS isbn_valide
        FROM (SELECT p_partkey, CASE p_size WHEN 1 THEN NULL WHEN 2 THEN ' ' || isbn WHEN 3 THEN substr(isbn, 1, 12)
                     WHEN 4 THEN '977' || substr(isbn, 4, 10) ELSE isbn END AS w
              FROM part JOIN isbns ON p_partkey = k)""").replace("CAST(substr(trim(w)", "TRY_CAST(substr(trim(w)"),
    "isbn10_to_13_books": with_("isbns", f"""
        , tens AS ({ISBN10}), t13 AS (SELECT *, '978' || substr(isbn10, 1, 9) AS t FROM tens),
        done AS (SELECT p_partkey, isbn10, CASE WHEN good THEN
            t || CAST((10 - ({weighted('t', 12)}) % 10) % 10 AS VARCHAR) END AS isbn13 FROM t13)
        SELECT p_partkey, isbn10, isbn13, isbn13 AS normalise FROM done"""),
    "stock_total": with_("isbns stock", """
        SELECT isbn, code_entrepot, date_position, qte_disponible, qte_pilonnee,
               CAST(qte_disponible + qte_reservee + coalesce(qte_transit, 0) AS INTEGER) AS qte_totale FROM stock"""),
    "display_name": with_("authors", "SELECT code_auteur, nom_complet FROM authors"),
    "null_flag": with_("authors", "SELECT code_auteur, date_deces IS NULL AS est_vivant FROM authors"),
    "accent_search": "SELECT doc_id, lang FROM documents WHERE "
    + " OR ".join(f"text LIKE '%{c}%'" for c in SEARCHED_IN_NAMES),
    "accent_audit": HELD,
    "dim_date": with_("isbns sales", """
        , span AS (SELECT min(date_vente) AS a, max(date_vente) AS b FROM sales),
        days AS (SELECT CAST(unnest(generate_series(date_trunc('year', a),
                    date_trunc('year', b) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
        SELECT d AS date_id, CAST(year(d) AS INTEGER) AS annee, CAST(month(d) AS INTEGER) AS mois,
               CAST(day(d) AS INTEGER) AS jour, CAST(quarter(d) AS INTEGER) AS trimestre,
               CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END AS semestre,
               CAST(dayofweek(d) + 1 AS INTEGER) AS jour_semaine, dayname(d) AS nom_jour, monthname(d) AS nom_mois,
               CAST(weekofyear(d) AS INTEGER) AS semaine_annee,
               CASE WHEN month(d) IN (1, 2, 3) THEN 'Hiver' WHEN month(d) IN (4, 5, 6) THEN 'Printemps'
                    WHEN month(d) IN (8, 9) THEN 'Rentrée littéraire' WHEN month(d) = 7 THEN 'Été (prix littéraires)'
                    ELSE 'Fin d''année (Noël)' END AS saison_editoriale,
               month(d) IN (8, 9) AS est_rentree_litteraire, month(d) = 12 AS est_noel FROM days"""),
    "fact_stock": with_("isbns stock", """
        SELECT isbn, code_entrepot, date_position, qte_disponible, qte_reservee, qte_transit, qte_pilonnee,
               CAST(qte_disponible + qte_reservee + coalesce(qte_transit, 0) AS INTEGER) AS qte_totale
        FROM stock WHERE valid"""),
    "fk_orphans_sales": with_("isbns", """
        SELECT isbn, count(*) AS orphan_rows FROM lineitem JOIN isbns ON l_partkey = k WHERE NOT valid GROUP BY isbn"""),
    "fk_orphans_books": with_("isbns books publishers", """
        SELECT b.code_editeur, count(*) AS orphan_rows FROM books b
        LEFT JOIN publishers p ON p.code_editeur = b.code_editeur AND p.active
        WHERE p.code_editeur IS NULL GROUP BY b.code_editeur"""),
    "calendar_orphans": with_("isbns sales", """
        , span AS (SELECT date_trunc('year', min(date_vente)) AS a,
                          date_trunc('year', max(date_vente)) + INTERVAL 1 YEAR AS b
                   FROM sales WHERE type_mouvement = 'Retour')
        SELECT date_reglement AS date_id, count(*) AS orphan_rows FROM sales, span
        WHERE date_reglement IS NULL OR date_reglement < a OR date_reglement >= b GROUP BY date_reglement"""),
    "latest_position": with_("isbns stock", f"""
        SELECT isbn AS SKISBN, code_entrepot AS SKENTR, {code('date_position')} AS SKDTPS, qte_disponible AS SKQTDS,
               qte_reservee AS SKQTRS, qte_transit AS SKQTTR, qte_pilonnee AS SKQTPI
        FROM (SELECT *, rank() OVER (PARTITION BY isbn, code_entrepot ORDER BY date_position DESC) AS r FROM stock)
        WHERE r = 1"""),
    "book_authors": with_("isbns bridge authors", """
        SELECT isbn, code_auteur, role, ordre, coalesce(nom_complet, 'Inconnu') AS nom_complet
        FROM bridge LEFT JOIN authors USING (code_auteur)"""),
    "lead_authors": with_("isbns bridge authors", """
        SELECT isbn, role, code_auteur, coalesce(nom_complet, 'Inconnu') AS nom_complet, nb_auteurs FROM (
            SELECT isbn, role, code_auteur, nom_complet, count(*) OVER (PARTITION BY isbn, role) AS nb_auteurs,
                   row_number() OVER (PARTITION BY isbn, role ORDER BY ordre, code_auteur) AS place
            FROM bridge LEFT JOIN authors USING (code_auteur)) WHERE place = 1"""),
    "resolve_codes": with_("isbns sales", f"""
        SELECT canal, code_entrepot, count(*) AS nb_mouvements, {cash('sum(montant_ttc)')} AS montant_ttc,
               coalesce(any_value(r_name), 'Inconnu') AS libelle_canal, coalesce(any_value(s_name), 'Inconnu') AS libelle_entrepot
        FROM sales LEFT JOIN region ON canal = {case('r_regionkey + 1', {1: 'LIB', 2: 'GMS', 3: 'WEB', 4: 'EXP', 5: 'CLB'}, "'?'")}
        LEFT JOIN supplier ON code_entrepot = {keyed('W', 's_suppkey')} GROUP BY canal, code_entrepot"""),
    "sales_by_publisher_author_month": with_("isbns sales good_sales books publishers authors bridge", f"""
        , lead AS (SELECT isbn, code_auteur, row_number() OVER (PARTITION BY isbn ORDER BY ordre, code_auteur) AS place
                   FROM bridge WHERE role = 'AUT')
        SELECT b.code_editeur, coalesce(p.nom_editeur, 'Inconnu') AS nom_editeur, l.code_auteur,
               coalesce(a.nom_complet, 'Inconnu') AS nom_complet, CAST(y AS INTEGER) AS annee_vente,
               CAST(m AS INTEGER) AS mois_vente, {cash('sum(montant_ttc)')} AS montant_ttc
        FROM good_sales s LEFT JOIN books b USING (isbn)
        LEFT JOIN publishers p ON p.code_editeur = b.code_editeur AND p.active
        LEFT JOIN lead l ON l.isbn = s.isbn AND l.place = 1
        LEFT JOIN authors a ON a.code_auteur = l.code_auteur GROUP BY ALL"""),
    "amount_balance": with_("isbns sales good_sales", f"""
        SELECT {cash('b')} AS total_bronze, {cash('s')} AS total_silver, {cash('g')} AS total_gold,
               {cash('x')} AS total_exclu, {cash('b - s')} AS ecart_bronze_silver, {cash('s - g')} AS ecart_silver_gold
        FROM {AMOUNT_TOTALS}"""),
    "control_totals": with_("isbns sales", f"""
        SELECT 'VENTEP' AS table_name, count(*) AS nb_lignes, {cash('sum(montant_ht)')} AS total_ht,
               {cash('sum(montant_ttc)')} AS total_ttc, {big('sum(quantite)')} AS total_qte,
               {code('min(date_vente)')} AS date_min, {code('max(date_vente)')} AS date_max FROM sales"""),
    "table_counts": " UNION ALL ".join(
        f"SELECT '{src}' AS table_name, count(*) AS row_count FROM {given}" for src, given in COUNT_SOURCES.values()
    ),
    "load_verification": with_("isbns sales good_sales", f"""
        SELECT count(*) AS nb_lignes, count(DISTINCT isbn) AS nb_isbn, min(date_vente) AS date_min,
               max(date_vente) AS date_max, {cash('sum(montant_ht)')} AS ca_total FROM good_sales"""),
    "isbn_invalid_rate": with_("isbns", f"""
        SELECT count(*) FILTER (NOT valid) AS nb_invalides, count(*) AS nb_total,
               CAST({pct('count(*) FILTER (NOT valid)', 'count(*)')} AS DECIMAL(9,6)) AS pct_invalides FROM isbns"""),
    "net_sales": with_("isbns sales good_sales", f"""
        SELECT type_mouvement, count(*) AS nb_mouvements, {big('sum(quantite)')} AS quantite,
               {cash('sum(montant_ht)')} AS montant_ht, {cash('sum(montant_ttc)')} AS montant_ttc
        FROM good_sales GROUP BY type_mouvement"""),
    "sales_by_book_day_channel": with_("isbns sales good_sales", f"""
        SELECT isbn, date_vente, canal, {big('sum(quantite)')} AS quantite, {cash('sum(montant_ht)')} AS montant_ht,
               {cash('sum(montant_ttc)')} AS montant_ttc FROM good_sales GROUP BY ALL"""),
    "sales_by_month": with_("isbns sales good_sales", f"""
        SELECT CAST(y AS INTEGER) AS annee_vente, CAST(m AS INTEGER) AS mois_vente, count(*) AS nb_mouvements, {SALE_SUMS}
        FROM good_sales GROUP BY ALL"""),
    "top_authors": with_("isbns sales good_sales bridge wrote authors", f"""
        SELECT code_auteur, coalesce(any_value(nom_complet), 'Inconnu') AS nom_complet, {SALE_SUMS}
        FROM good_sales JOIN wrote USING (isbn) LEFT JOIN authors USING (code_auteur)
        GROUP BY code_auteur ORDER BY sum(montant_ttc) DESC, code_auteur LIMIT 10"""),
    "share_by_format": with_("isbns sales good_sales books", f"""
        SELECT libelle_format, {cash('t')} AS montant_ttc, CAST(CAST(t AS DOUBLE) / sum(t) OVER () AS DECIMAL(9,6)) AS part
        FROM (SELECT coalesce(libelle_format, 'Inconnu') AS libelle_format, sum(montant_ttc) AS t
              FROM good_sales LEFT JOIN books USING (isbn) GROUP BY 1)"""),
    "sales_filtered": with_("isbns sales good_sales books", f"""
        SELECT CAST(y AS INTEGER) AS annee_vente, CAST(m AS INTEGER) AS mois_vente, {SALE_SUMS}
        FROM good_sales JOIN books USING (isbn)
        WHERE y = {cat.REPORT_YEAR} AND code_editeur = '{cat.REPORT_PUBLISHER}' GROUP BY ALL"""),
    "author_total_window": with_("isbns sales good_sales bridge wrote", f"""
        SELECT code_auteur, annee_vente, {cash('t')} AS montant_ttc, {cash('sum(t) OVER (PARTITION BY code_auteur)')} AS total_auteur
        FROM (SELECT code_auteur, CAST(y AS INTEGER) AS annee_vente, sum(montant_ttc) AS t
              FROM good_sales JOIN wrote USING (isbn) GROUP BY ALL)"""),
    "royalties": with_("isbns sales good_sales bridge line_totals contracts", f"""
        , daily AS (SELECT isbn, date_vente, sum(montant_ht) AS ht FROM good_sales GROUP BY ALL),
        named AS (SELECT DISTINCT isbn, code_auteur FROM bridge),
        offered AS (
            SELECT d.isbn, d.date_vente, d.ht, c.code_auteur, c.num_contrat, c.date_debut, 1 AS titled
            FROM daily d JOIN contracts c ON c.isbn = d.isbn AND d.date_vente >= c.date_debut
                 AND (c.date_fin IS NULL OR d.date_vente <= c.date_fin)
            UNION ALL
            SELECT d.isbn, d.date_vente, d.ht, c.code_auteur, c.num_contrat, c.date_debut, 0
            FROM daily d JOIN named n ON n.isbn = d.isbn JOIN contracts c ON c.code_auteur = n.code_auteur
                 AND c.isbn IS NULL AND d.date_vente >= c.date_debut
                 AND (c.date_fin IS NULL OR d.date_vente <= c.date_fin)),
        chosen AS (SELECT num_contrat, sum(ht) AS ht FROM (
            SELECT *, row_number() OVER (PARTITION BY isbn, date_vente, code_auteur
                   ORDER BY titled DESC, date_debut DESC, num_contrat DESC) AS place FROM offered)
            WHERE place = 1 GROUP BY num_contrat),
        due AS (SELECT c.num_contrat, c.code_auteur, {cash('ht')} AS base_ht, c.avance,
                       CAST({cash('ht')} * pct * 0.01 AS DECIMAL(28,2)) AS d
                FROM contracts c LEFT JOIN chosen USING (num_contrat))
        SELECT num_contrat, code_auteur, base_ht, {cash('d')} AS droits_dus, {cash('avance')} AS avance,
               {cash('greatest(CAST(d AS DECIMAL(28,2)) - avance, 0)')} AS droits_a_payer FROM due"""),
    "royalty_ledger": with_("isbns sales good_sales bridge line_totals contracts", f"""
        , daily AS (SELECT isbn, date_vente, sum(montant_ht) AS ht FROM good_sales GROUP BY ALL),
        named AS (SELECT DISTINCT isbn, code_auteur FROM bridge),
        offered AS (
            SELECT d.isbn, d.date_vente, d.ht, c.code_auteur, c.num_contrat, c.date_debut, 1 AS titled
            FROM daily d JOIN contracts c ON c.isbn = d.isbn AND d.date_vente >= c.date_debut
                 AND (c.date_fin IS NULL OR d.date_vente <= c.date_fin)
            UNION ALL
            SELECT d.isbn, d.date_vente, d.ht, c.code_auteur, c.num_contrat, c.date_debut, 0
            FROM daily d JOIN named n ON n.isbn = d.isbn JOIN contracts c ON c.code_auteur = n.code_auteur
                 AND c.isbn IS NULL AND d.date_vente >= c.date_debut
                 AND (c.date_fin IS NULL OR d.date_vente <= c.date_fin)),
        chosen AS (SELECT num_contrat, CAST(date_trunc('year', date_vente) AS DATE) AS periode, sum(ht) AS ht FROM (
            SELECT *, row_number() OVER (PARTITION BY isbn, date_vente, code_auteur
                   ORDER BY titled DESC, date_debut DESC, num_contrat DESC) AS place FROM offered)
            WHERE place = 1 GROUP BY ALL),
        run AS (SELECT num_contrat, code_auteur, periode, {cash('ht')} AS base_ht, CAST(avance AS DECIMAL(28,2)) AS avance, pct,
                       CAST(sum(ht) OVER (PARTITION BY num_contrat ORDER BY periode) AS DECIMAL(28,2)) AS whole
                FROM chosen JOIN contracts USING (num_contrat)),
        due AS (SELECT *, CAST(CAST(whole * pct * 0.01 AS DECIMAL(28,2)) AS DECIMAL(28,2)) AS d FROM run),
        cum AS (SELECT *, least(greatest(d, 0), avance) AS off, greatest(d - avance, 0) AS paid FROM due)
        SELECT num_contrat, code_auteur, periode, base_ht,
               CAST(d - coalesce(lag(d) OVER w, 0) AS DECIMAL(28,2)) AS droits_dus, d AS droits_cumules,
               CAST(off - coalesce(lag(off) OVER w, 0) AS DECIMAL(28,2)) AS avance_imputee,
               CAST(avance - off AS DECIMAL(28,2)) AS avance_restante,
               CAST(paid - coalesce(lag(paid) OVER w, 0) AS DECIMAL(28,2)) AS droits_a_payer
        FROM cum WINDOW w AS (PARTITION BY num_contrat ORDER BY periode)"""),
    "order_fill": with_("isbns line_totals cmd", f"""
        SELECT statut, count(*) AS nb_commandes, {big('sum(qte_commandee)')} AS qte_commandee,
               {big('sum(qte_livree)')} AS qte_livree,
               CAST(coalesce(sum(qte_commandee), 0) - coalesce(sum(qte_livree), 0) AS BIGINT) AS qte_ouverte,
               CAST(CAST(sum(qte_livree) AS DOUBLE) / sum(qte_commandee) AS DECIMAL(9,6)) AS taux_service,
               CAST(CAST(sum(date_livraison - date_commande) AS DOUBLE) / count(date_livraison) AS DECIMAL(12,4)) AS delai_moyen
        FROM cmd GROUP BY statut"""),
    "stock_by_site": with_("isbns stock", f"""
        SELECT code_entrepot, date_position, count(*) AS nb_positions, {big('sum(qte_disponible)')} AS qte_disponible,
               {big('sum(qte_reservee)')} AS qte_reservee, {big('sum(qte_transit)')} AS qte_transit,
               {big('sum(qte_pilonnee)')} AS qte_pilonnee,
               {big('sum(qte_disponible + qte_reservee + coalesce(qte_transit, 0))')} AS qte_totale
        FROM stock WHERE valid GROUP BY ALL"""),
    "dedupe_latest": with_("isbns sales", f"SELECT {SILVER_SALES_COLUMNS} FROM ({LATEST_SALES.format(last='type_mouvement')})"),
    "dedupe_loss": with_("isbns sales", """
        SELECT 'num_mouvement' AS key_name, count(*) AS total_rows, count(DISTINCT num_mouvement) AS distinct_keys,
               count(*) - count(DISTINCT num_mouvement) AS rows_lost FROM sales
        UNION ALL
        SELECT 'isbn_date_canal', count(*), count(DISTINCT (isbn, date_vente, canal)),
               count(*) - count(DISTINCT (isbn, date_vente, canal)) FROM sales"""),
    "surrogate_keys": with_("isbns", """
        SELECT 'dim_ouvrages' AS table_name, count(*) AS row_count, count(DISTINCT isbn) AS key_count,
               CAST(0 AS BIGINT) AS collisions FROM isbns WHERE valid
        UNION ALL SELECT 'dim_auteurs', count(*), count(DISTINCT c_custkey), 0 FROM customer"""),
    "dim_publisher": with_("publishers", "SELECT * EXCLUDE (active) FROM publishers WHERE active"),
    "dim_author": with_("authors", "SELECT * FROM authors"),
    "dim_book": with_("isbns books", """
        SELECT * EXCLUDE (valid), CASE WHEN prix_ttc < 10 THEN '< 10 €' WHEN prix_ttc < 20 THEN '10-20 €'
               WHEN prix_ttc < 30 THEN '20-30 €' ELSE '≥ 30 €' END AS tranche_prix FROM books WHERE valid"""),
    "fact_sales": FACT_SALES,
    "excluded_sales": with_("isbns sales", """
        SELECT num_mouvement, isbn, date_vente, quantite, montant_ttc FROM sales WHERE NOT valid"""),
    "dim_collection": with_("publishers", f"""
        SELECT code_collection, nom_collection, c.code_editeur, nom_editeur, DATE '2020-01-01' AS date_creation, 'A' AS statut
        FROM (SELECT DISTINCT 'C' || regexp_extract(p_brand, '([0-9]+)', 1) || substr(p_type, 1, 3) AS code_collection,
                     p_brand || ' ' || p_type AS nom_collection,
                     {keyed('S', "regexp_extract(p_brand, '([0-9]+)', 1)")} AS code_editeur FROM part) c
        LEFT JOIN publishers p ON p.code_editeur = c.code_editeur"""),
    "dim_site": f"""
        SELECT {keyed('W', 's_suppkey')} AS code_entrepot, s_name AS nom_entrepot, n_name AS ville
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "fact_orders": with_("isbns line_totals cmd", """
        SELECT num_commande, isbn, date_commande, date_livraison, CAST(year(date_commande) AS INTEGER) AS annee_commande,
               code_client, statut, qte_commandee, coalesce(qte_livree, 0) AS qte_livree,
               CAST(qte_commandee - coalesce(qte_livree, 0) AS INTEGER) AS qte_ouverte,
               CAST(date_livraison - date_commande AS INTEGER) AS delai_jours, montant_ht FROM cmd"""),
    "cluster_same_rows": FACT_SALES,
    "freshness": with_("log", f"""
        , watched AS (SELECT unnest({cat.WATCHED}) AS table_name),
        seen AS (SELECT table_name, max(loaded_at) AS last_load,
                        last(row_count ORDER BY loaded_at, row_count) AS n FROM log
                 WHERE loaded_at <= TIMESTAMP '{cat.AS_OF}' GROUP BY table_name),
        aged AS (SELECT table_name, last_load, n, date_sub('second', last_load, TIMESTAMP '{cat.AS_OF}') AS age
                 FROM watched LEFT JOIN seen USING (table_name))
        SELECT table_name, last_load, CAST(CAST(age AS DOUBLE) / 3600 AS DECIMAL(12,1)) AS age_hours,
               (last_load IS NULL OR age > 86400) AS is_stale, {big('n')} AS row_count,
               CASE WHEN last_load IS NULL OR age > 86400 THEN 'STALE' ELSE 'HEALTHY' END AS status FROM aged"""),
    "volume_anomaly": with_("log", """
        , daily AS (SELECT table_name, CAST(loaded_at AS DATE) AS load_day, CAST(sum(row_count) AS BIGINT) AS row_count
                    FROM log GROUP BY ALL),
        seen AS (SELECT *, count(*) OVER w AS n, sum(row_count) OVER w AS s, sum(row_count * row_count) OVER w AS q
                 FROM daily WINDOW w AS (PARTITION BY table_name ORDER BY load_day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
        SELECT table_name, load_day, row_count,
               CASE WHEN n >= 2 THEN CAST(CAST(s AS DOUBLE) / n AS DECIMAL(18,4)) END AS trailing_mean,
               coalesce(n >= 2 AND (row_count * n - s) * (row_count * n - s) > 4 * (n * q - s * s), false) AS is_anomaly
        FROM seen"""),
    "cosine_topk_per_label": """
        WITH q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
                   WHERE vec_id IN (SELECT min(vec_id) FROM embeddings GROUP BY label)),
        scored AS (SELECT query_id, vec_id, list_cosine_similarity(e, CAST(embedding AS DOUBLE[])) AS s
                   FROM q JOIN embeddings ON vec_id <> query_id)
        SELECT query_id, vec_id, CAST(place AS INTEGER) AS place, CAST(s AS DECIMAL(9,6)) AS score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS place FROM scored)
        WHERE place <= 5""",
    "cosine_blocks_skipped": "SELECT count(*) FILTER (vec_id % 20 = 0) AS queries, true AS accounted_for FROM embeddings",
    "gate_completeness": with_("isbns sales good_sales publishers", COMPLETENESS),
    "gate_row_loss": "SELECT " + gate_row(
        "'row_loss ventes'", f"CASE WHEN {pct('b - s', 'b')} > 0.1 THEN 'FAIL' ELSE 'PASS' END", pct("b - s", "b"), 0.1,
        told(("bronze", "b"), ("silver", "s")),
    ) + " FROM (SELECT count(*) AS b, count(DISTINCT l_orderkey * 10 + l_linenumber) AS s FROM lineitem)",
    "gate_null_ratio": with_("isbns sales authors", NULL_GATES),
    "gate_unreadable": " UNION ALL ".join(
        "SELECT " + gate_row(
            f"'unreadable ouvrages.{f.source}'", f"CASE WHEN bad = 0 THEN 'PASS' ELSE '{'WARN' if f.kind == 'cyymmdd' else 'FAIL'}' END",
            "bad", 0, told(("unreadable", "bad"), ("rows", "n")))
        + f" FROM (SELECT count(*) FILTER ({'k % 503 = 0 AND k % 211 <> 0' if f.source == 'OVDTPB' else 'false'}) AS bad, count(*) AS n"
        " FROM (SELECT p_partkey AS k FROM part))"
        for f in table("ouvrages").fields if f.kind != "char"),
    "gate_isbn": with_("isbns sales", isbn_gate("ouvrages", "isbns", 5.0) + " UNION ALL " + isbn_gate("ventes", "sales", 1.0)),
    "gate_isbn_shape": with_("isbns sales", isbn_shape_gate(1.0)),
    "gate_dates": with_("isbns sales books",
                        date_gates("ouvrages", "books", "date_publication") + " UNION ALL "
                        + date_gates("ventes", "sales", "date_reglement")),
    "gate_expected": with_("isbns books", " UNION ALL ".join(
        expected_gate(e.check, e.where, e.holds.replace("isbn_valide", "valid")) for e in cat.EXPECTED_BOOKS)),
    "gate_amounts": with_("isbns sales good_sales", AMOUNT_GATES),
    "gate_accents": ACCENT_GATE.format(held=HELD),
    "gate_integrity": with_("isbns sales", integrity_gate(
        "fk ventes to ouvrages", orphan_sql("sales", "isbn", "SELECT isbn AS kk FROM isbns WHERE valid"))
        + " UNION ALL " + integrity_gate("fk ventes to ref_canaux", "SELECT canal AS k FROM sales WHERE canal = 'XXX'")),
    "gate_summary": with_("isbns sales good_sales books publishers authors", f"""
        , checks AS ({GATE_PARTS})
        SELECT count(*) FILTER (status = 'PASS') AS nb_pass, count(*) FILTER (status = 'WARN') AS nb_warn,
               count(*) FILTER (status = 'FAIL') AS nb_fail,
               CASE WHEN count(*) FILTER (status = 'FAIL') > 0 THEN 'FAIL' ELSE 'PASS' END AS global_status,
               CASE WHEN count(*) FILTER (status = 'FAIL') > 0 THEN 'HUMAN_REVIEW_REQUIRED' ELSE 'GO' END AS decision
        FROM checks"""),
}
