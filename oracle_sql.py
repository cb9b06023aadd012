"""DuckDB SQL twins of the registered queries (independent oracles).

Each text only reads the pre-registered base tables. The adapter views are
written out again here as CTEs, in plain SQL, so the oracle shares no code
with the Spark side.

Parity notes
* Spark rounds a DOUBLE HALF_UP on its shortest decimal text; ``rnd`` does
  the same in DuckDB via VARCHAR -> DECIMAL.
* Means of exact decimals are rounded HALF_UP with integer arithmetic
  (``half_up``), which equals Spark's exact decimal division + round.
* DuckDB sorts NULLs last by default and Spark first; every ORDER BY here
  says which one it wants.
"""

from __future__ import annotations

YEARS = list(range(1995, 2002))
LIMITS = [15, 20, 25, 30, 35, 40, 45]
FINAL = YEARS[-1]
SHARES = [f"proporcao_aluno_nivel_{n}" for n in range(9)]
STATE_NET, CITY_NET = "BUILDING", "AUTOMOBILE"


def rnd(x: str) -> str:
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(28,17)), 2) AS DOUBLE)"


def half_up(num: str, den: str) -> str:
    """HALF_UP(num / den, 2) for a non-negative DECIMAL(., 2) ``num`` and integral ``den``."""
    n = f"CAST(({num}) * 100 AS HUGEINT)"
    d = f"CAST(({den}) AS HUGEINT)"
    return f"CAST((2 * {n} + {d}) // (2 * {d}) AS DOUBLE) / 100"


def pct(num: str, den: str) -> str:
    return f"CAST(100 AS DOUBLE) * {num} / {den}"


# ------------------------------------------------------------------ adapters
V_RESULT = f"""v_result AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS ano, CAST(c.c_nationkey AS VARCHAR) AS local_id,
         n.n_name AS local_nome, o.o_orderpriority AS serie, c.c_mktsegment AS rede,
         {pct("count_if(o.o_orderstatus = 'F')", "nullif(count_if(o.o_orderstatus <> 'P'), 0)")} AS taxa_alfabetizacao,
         CAST(count(*) AS DOUBLE) AS media_portugues,
         {pct("count_if(o.o_orderstatus = 'O')", "count(*)")} AS proporcao_aluno_nivel_5,
         {pct("count_if(o.o_orderstatus = 'P')", "count(*)")} AS proporcao_aluno_nivel_6
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2, 3, 4, 5)"""

_METAS = ",\n         ".join(
    [pct(f"count_if(l.l_quantity <= {lim})", "count(*)") + f" AS meta_{y}" for y, lim in zip(YEARS[:-1], LIMITS)]
    + [pct(f"count_if(l.l_quantity <= {LIMITS[-1]})", "nullif(count_if(l.l_linenumber < 99), 0)") + f" AS meta_{FINAL}"])

V_TARGET = f"""v_target AS (
  SELECT CAST(year(l.l_shipdate) AS INTEGER) AS ano, CAST(s.s_nationkey AS VARCHAR) AS local_id, n.n_name AS local_nome,
         {pct("count_if(l.l_returnflag = 'R')", "count(*)")} AS taxa_alfabetizacao,
         {_METAS}
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
  GROUP BY 1, 2, 3)"""

V_TARGET_COUNTRY = f"""v_target_country AS (
  SELECT CAST(year(l.l_shipdate) AS INTEGER) AS ano,
         {pct("count_if(l.l_returnflag = 'R')", "count(*)")} AS taxa_alfabetizacao,
         {_METAS}
  FROM lineitem l GROUP BY 1)"""

META_COLS = ", ".join(f"meta_{y}" for y in YEARS)

STATE_VIEWS = f"""results_state AS (
  SELECT ano, 'U' || local_id AS sigla_uf, local_nome AS sigla_uf_nome, serie, rede, taxa_alfabetizacao,
         media_portugues, proporcao_aluno_nivel_5, proporcao_aluno_nivel_6 FROM v_result),
targets_state AS (
  SELECT ano, 'U' || local_id AS sigla_uf, local_nome AS sigla_uf_nome, taxa_alfabetizacao, {META_COLS} FROM v_target)"""

CITY_KEY = "CAST(1000000 + CAST(local_id AS INTEGER) AS VARCHAR)"
CITY_VIEWS = f"""results_city AS (
  SELECT ano, {CITY_KEY} AS id_municipio, local_nome AS id_municipio_nome, serie, rede, taxa_alfabetizacao,
         media_portugues, proporcao_aluno_nivel_5, proporcao_aluno_nivel_6 FROM v_result),
targets_city AS (
  SELECT ano, {CITY_KEY} AS id_municipio, local_nome AS id_municipio_nome, taxa_alfabetizacao, {META_COLS}
  FROM v_target)"""

V_STUDENTS = """v_students AS (
  SELECT CAST(year(l.l_shipdate) AS INTEGER) AS ano, CAST(c.c_nationkey AS VARCHAR) AS id_municipio,
         CAST(l.l_suppkey AS VARCHAR) AS id_escola, CAST(l.l_orderkey AS VARCHAR) AS id_aluno,
         l.l_linestatus AS serie, c.c_mktsegment AS rede,
         CASE l.l_returnflag WHEN 'R' THEN ' Alfabetizado ' WHEN 'A' THEN 'NÃO alfabetizado' END AS alfabetizado,
         CASE WHEN l.l_linenumber = 7 THEN NULL ELSE CAST(l.l_extendedprice AS DECIMAL(15,2)) END AS proficiencia,
         CAST(l.l_quantity - 5 AS DECIMAL(10,0)) AS peso_aluno
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey)"""

V_DICTIONARY = """v_dictionary AS (
  SELECT * FROM (VALUES ('orders', 'o_orderstatus', 'F', 'Finished'), ('orders', 'o_orderstatus', 'O', 'Open'),
    ('orders', 'c_mktsegment', 'BUILDING', 'Public'), ('orders', 'c_mktsegment', 'MACHINERY', 'Private'),
    ('lineitem', 'l_linestatus', 'O', 'Second'), ('lineitem', 'l_returnflag', 'R', 'Returned'), ('lineitem', 'l_returnflag', 'A', 'Accepted'))
    AS t(id_tabela, nome_coluna, chave, valor))"""

DIRECTORY = """directory AS (SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS sigla, n_name AS nome FROM nation)"""

V_RAW = """v_raw_strings AS (
  SELECT CASE l_linenumber WHEN 2 THEN concat(year(l_shipdate), '.0') WHEN 6 THEN concat(' ', year(l_shipdate))
              ELSE concat(year(l_shipdate)) END AS ano,
         CASE WHEN l_linenumber = 3 THEN '   ' ELSE concat('  ', l_returnflag, ' ') END AS serie,
         CAST(l_orderkey AS VARCHAR) AS id_aluno, CAST(l_linenumber AS VARCHAR) AS id_escola,
         CASE WHEN l_linenumber = 5 THEN 'n/d'
              ELSE concat(CAST(CAST(trunc(l_quantity * 3) AS INTEGER) AS VARCHAR), ',5') END AS taxa_alfabetizacao,
         CASE WHEN l_linenumber = 4 THEN 'x' ELSE concat(l_linenumber, '.0') END AS nivel_alfabetizacao
  FROM lineitem),
raw_clean AS (
  SELECT nullif(trim(ano), '') AS ano, nullif(trim(serie), '') AS serie, nullif(trim(id_aluno), '') AS id_aluno,
         nullif(trim(id_escola), '') AS id_escola, nullif(trim(taxa_alfabetizacao), '') AS taxa_alfabetizacao,
         nullif(trim(nivel_alfabetizacao), '') AS nivel_alfabetizacao
  FROM v_raw_strings),
raw_fixed AS (
  SELECT CAST(TRY_CAST(ano AS DOUBLE) AS INTEGER) AS ano, serie, id_aluno, id_escola,
         TRY_CAST(replace(taxa_alfabetizacao, ',', '.') AS DOUBLE) AS taxa_alfabetizacao,
         CAST(TRY_CAST(nivel_alfabetizacao AS DOUBLE) AS INTEGER) AS nivel_alfabetizacao
  FROM raw_clean),
raw_required AS (SELECT * FROM raw_fixed WHERE ano IS NOT NULL AND id_aluno IS NOT NULL AND serie IS NOT NULL),
raw_dedup AS (
  SELECT ano, serie, id_aluno, id_escola, taxa_alfabetizacao, nivel_alfabetizacao FROM (
    SELECT *, row_number() OVER (PARTITION BY ano, id_aluno, id_escola
                                 ORDER BY serie ASC NULLS LAST, taxa_alfabetizacao ASC NULLS LAST,
                                          nivel_alfabetizacao ASC NULLS LAST) AS rn
    FROM raw_required) WHERE rn = 1)"""

V_EVENTS = """v_events AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(event_id % 800 AS VARCHAR) END AS evento_id,
         CAST(event_id AS VARCHAR) AS id_mensagem_sqs, CAST(ts AS TIMESTAMP) AS timestamp_evento,
         CAST(ts AS TIMESTAMP) AS recebido_em_utc, CAST(1995 + event_id % 7 AS INTEGER) AS ano_referencia,
         CASE WHEN event_type IN ('view', 'click') THEN 'UF' WHEN event_type = 'error' THEN 'X'
              ELSE 'Municipio' END AS nivel,
         CASE WHEN event_id % 53 = 0 THEN 'XYZ' ELSE 'U' || CAST(user_id % 10 AS VARCHAR) END AS sigla_uf,
         CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE CAST(1000000 + user_id AS VARCHAR) END AS id_municipio,
         value AS taxa_alfabetizacao
  FROM events)"""


def normalize_network_sql(level: str, network: str) -> str:
    low = f"lower(trim({network}))"
    return (f"CASE WHEN starts_with({low}, 'municip') THEN 'Municipal' WHEN starts_with({low}, 'public') THEN 'Pública' "
            f"WHEN {level} = 'UF' THEN 'Pública' WHEN {level} = 'Municipio' THEN 'Municipal' ELSE trim({network}) END")


FLAT = f"""flat AS (
  SELECT id_mensagem_sqs, recebido_em_utc, evento_id, CAST(NULL AS BIGINT) AS sequencia, timestamp_evento,
         CAST(NULL AS VARCHAR) AS tipo_evento, ano_referencia, trim(nivel) AS nivel, upper(trim(sigla_uf)) AS sigla_uf,
         trim(id_municipio) AS id_municipio, CAST(NULL AS VARCHAR) AS nome_localidade, CAST(NULL AS VARCHAR) AS serie,
         {normalize_network_sql("trim(nivel)", "CAST(NULL AS VARCHAR)")} AS rede,
         taxa_alfabetizacao, CAST(NULL AS DOUBLE) AS media_portugues,
         CAST(NULL AS DOUBLE) AS proporcao_niveis_adequados, CAST(NULL AS VARCHAR) AS origem
  FROM v_events)"""

VALIDATED = """validated AS (
  SELECT *, concat_ws('; ',
    CASE WHEN evento_id IS NULL OR trim(evento_id) = '' THEN 'evento_id ausente' END,
    CASE WHEN timestamp_evento IS NULL THEN 'timestamp_evento inválido' END,
    CASE WHEN ano_referencia IS NULL THEN 'ano_referencia ausente' END,
    CASE WHEN NOT coalesce(nivel IN ('UF', 'Municipio'), false) THEN 'nível inválido' END,
    CASE WHEN sigla_uf IS NULL OR length(sigla_uf) <> 2 THEN 'sigla_uf inválida' END,
    CASE WHEN nivel = 'Municipio' AND (id_municipio IS NULL OR length(id_municipio) <> 7)
         THEN 'id_municipio inválido' END,
    CASE WHEN taxa_alfabetizacao IS NULL THEN 'taxa_alfabetizacao ausente' END,
    CASE WHEN taxa_alfabetizacao IS NOT NULL AND NOT (taxa_alfabetizacao BETWEEN 0 AND 100)
         THEN 'taxa_alfabetizacao fora de 0 a 100' END,
    CASE WHEN media_portugues IS NOT NULL AND media_portugues < 0 THEN 'media_portugues negativa' END,
    CASE WHEN proporcao_niveis_adequados IS NOT NULL AND NOT (proporcao_niveis_adequados BETWEEN 0 AND 100)
         THEN 'proporcao_niveis_adequados fora de 0 a 100' END) AS motivo_rejeicao
  FROM flat)"""

DEDUPED = """deduped AS (
  SELECT * EXCLUDE (rn, motivo_rejeicao), CAST(year(recebido_em_utc) AS INTEGER) AS ano_ingestao,
         CAST(month(recebido_em_utc) AS INTEGER) AS mes_ingestao, CAST(day(recebido_em_utc) AS INTEGER) AS dia_ingestao
  FROM (SELECT *, row_number() OVER (PARTITION BY evento_id ORDER BY timestamp_evento DESC NULLS LAST,
                   recebido_em_utc DESC NULLS LAST, id_mensagem_sqs DESC NULLS LAST) AS rn
        FROM validated WHERE motivo_rejeicao = '') WHERE rn = 1)"""

CURRENT = """current_events AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY nivel, ano_referencia,
                                 CASE WHEN nivel = 'UF' THEN sigla_uf ELSE id_municipio END
                                 ORDER BY timestamp_evento DESC NULLS LAST, recebido_em_utc DESC NULLS LAST,
                                          id_mensagem_sqs DESC NULLS LAST, evento_id DESC NULLS LAST) AS rn
    FROM deduped) WHERE rn = 1)"""

EVENT_CTES = [V_EVENTS, FLAT, VALIDATED, DEDUPED, CURRENT]


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ------------------------------------------------------------------ integration
def integrate_sql(name: str, res: str, tgt: str, key: str, label_name: str, network: str, label: str,
                  extra_right: list[str]) -> str:
    year = "coalesce(r.ano, m.ano)"
    meta_ano = "CASE " + " ".join(f"WHEN {year} = {y} THEN m.meta_{y}" for y in YEARS) + " END"
    shares = ", ".join((f"r.{s}" if s in ("proporcao_aluno_nivel_5", "proporcao_aluno_nivel_6")
                        else f"CAST(NULL AS DOUBLE)") + f" AS {s}" for s in SHARES)
    metas = ", ".join(f"m.meta_{y} AS meta_{y}" for y in YEARS)
    extras = "".join(f"CAST(NULL AS INTEGER) AS {e}, " for e in extra_right)
    return f"""{name} AS (
  SELECT CAST({year} AS INTEGER) AS ano, coalesce(r.{key}, m.{key}) AS {key},
         coalesce(r.{label_name}, m.{label_name}) AS {label_name}, r.serie AS serie, '{label}' AS rede,
         r.taxa_alfabetizacao AS taxa_resultado, m.taxa_alfabetizacao AS taxa_referencia_meta,
         r.media_portugues AS media_portugues, {shares}, {metas},
         {meta_ano} AS meta_ano, {rnd(f"{meta_ano} - r.taxa_alfabetizacao")} AS gap_para_meta_ano,
         {rnd(f"m.meta_{FINAL} - r.taxa_alfabetizacao")} AS gap_para_meta_{FINAL},
         {extras}CAST(NULL AS DOUBLE) AS percentual_participacao,
         CASE WHEN r.{key} IS NOT NULL AND m.{key} IS NOT NULL THEN 'Correspondente'
              WHEN r.{key} IS NOT NULL THEN 'Somente resultado' ELSE 'Somente meta' END AS status_integracao
  FROM (SELECT * FROM {res} WHERE rede = '{network}') r FULL OUTER JOIN {tgt} m
    ON r.ano = m.ano AND r.{key} = m.{key})"""


INTEG_STATE = integrate_sql("integ_state", "results_state", "targets_state", "sigla_uf", "sigla_uf_nome", STATE_NET,
                            "Pública", [])
INTEG_CITY = integrate_sql("integ_city", "results_city", "targets_city", "id_municipio", "id_municipio_nome",
                           CITY_NET, "Municipal", ["nivel_alfabetizacao"])
STATE_BASE = [V_RESULT, V_TARGET, STATE_VIEWS]
CITY_BASE = [V_RESULT, V_TARGET, CITY_VIEWS]
BOTH_BASE = [V_RESULT, V_TARGET, STATE_VIEWS, CITY_VIEWS]


def band_sql(x: str, null_arm: bool = True) -> str:
    head = f"WHEN {x} IS NULL THEN 'Sem informação' " if null_arm else ""
    return (f"CASE {head}WHEN {x} >= 80 THEN 'Muito alto' WHEN {x} >= 70 THEN 'Alto' "
            f"WHEN {x} >= 60 THEN 'Intermediário' ELSE 'Baixo' END")


def compare_sql(integ: str, key: str, label_name: str, rank: str, extra: list[str]) -> str:
    extras = "".join(f"{e}, " for e in extra)
    return f"""SELECT ano, {key}, {label_name}, serie, rede, taxa_resultado, taxa_referencia_meta, meta_ano,
       meta_{FINAL}, gap_para_meta_ano, gap_para_meta_{FINAL}, {extras}percentual_participacao, status_integracao,
       CASE WHEN status_integracao <> 'Correspondente' THEN status_integracao
            WHEN meta_ano IS NULL THEN 'Sem meta para o ano'
            WHEN taxa_resultado >= meta_ano THEN 'Meta atingida' ELSE 'Abaixo da meta' END AS status_comparacao,
       CAST(dense_rank() OVER (PARTITION BY ano, rede ORDER BY taxa_resultado DESC NULLS LAST) AS INTEGER) AS {rank}
FROM {integ}"""


def indicators_sql(src: str, key: str, label_name: str, rank: str) -> str:
    share = ("CAST(0 AS DOUBLE) + coalesce(proporcao_aluno_nivel_5, CAST(0 AS DOUBLE)) + "
             "coalesce(proporcao_aluno_nivel_6, CAST(0 AS DOUBLE)) + CAST(0 AS DOUBLE) + CAST(0 AS DOUBLE)")
    return f"""SELECT ano, {key}, {label_name}, serie, rede, taxa_alfabetizacao, media_portugues,
       {share} AS proporcao_niveis_adequados, {band_sql("taxa_alfabetizacao")} AS faixa_desempenho,
       CAST(dense_rank() OVER (PARTITION BY ano, serie, rede ORDER BY taxa_alfabetizacao DESC NULLS LAST) AS INTEGER)
         AS {rank}
FROM {src}"""


def panel_status_sql(rate: str, target: str) -> str:
    return (f"CASE WHEN {rate} IS NULL OR {target} IS NULL THEN 'Sem informação' "
            f"WHEN {rate} >= {target} THEN 'Meta atingida' ELSE 'Abaixo da meta' END")


def targets_long_sql(src: str, level: str, key_cols: dict[str, str]) -> str:
    parts = []
    for y in YEARS:
        cols = []
        for out in ("sigla_uf", "nome_uf", "id_municipio", "nome_municipio", "rede"):
            cols.append(f"{key_cols[out]} AS {out}" if out in key_cols else f"CAST(NULL AS VARCHAR) AS {out}")
        parts.append(f"""SELECT '{level}' AS nivel_geografico, ano AS ano_referencia, {y} AS ano_meta, {", ".join(cols)},
       taxa_alfabetizacao, meta_{y} AS meta_alfabetizacao, {rnd(f"meta_{y} - taxa_alfabetizacao")} AS gap_para_meta,
       CAST(NULL AS DOUBLE) AS percentual_participacao, CAST(NULL AS INTEGER) AS nivel_alfabetizacao,
       {panel_status_sql("taxa_alfabetizacao", f"meta_{y}")} AS status_meta
FROM {src}""")
    return "\nUNION ALL\n".join(parts)


STATE_PANEL_COLS = {"sigla_uf": "sigla_uf", "nome_uf": "sigla_uf_nome"}
CITY_PANEL_COLS = {"id_municipio": "id_municipio", "nome_municipio": "id_municipio_nome"}


def hybrid_sql(name: str, level: str, integ: str) -> str:
    st = level == "UF"
    key = "sigla_uf" if st else "id_municipio"
    nm = "sigla_uf_nome" if st else "id_municipio_nome"
    state_col = "coalesce(s.sigla_uf, b.sigla_uf)" if st else "s.sigla_uf"
    city_col = "CAST(NULL AS VARCHAR)" if st else "coalesce(s.id_municipio, CAST(b.id_municipio AS VARCHAR))"
    return f"""{name} AS (
  SELECT '{level}' AS nivel, coalesce(s.ano_referencia, CAST(b.ano AS INTEGER)) AS ano_referencia,
         {state_col} AS sigla_uf, {city_col} AS id_municipio, coalesce(s.nome_localidade, b.{nm}) AS nome_localidade,
         coalesce(s.serie, b.serie) AS serie, coalesce(s.rede, b.rede) AS rede, s.evento_id AS evento_id,
         s.timestamp_evento AS timestamp_evento, s.recebido_em_utc AS recebido_em_utc,
         s.taxa_alfabetizacao AS taxa_streaming, s.media_portugues AS media_portugues_streaming,
         s.proporcao_niveis_adequados AS proporcao_niveis_adequados_streaming, b.taxa_resultado AS taxa_batch,
         b.meta_ano AS meta_ano, {rnd("s.taxa_alfabetizacao - b.taxa_resultado")} AS variacao_streaming_vs_batch,
         {rnd("b.meta_ano - s.taxa_alfabetizacao")} AS gap_streaming_para_meta,
         CASE WHEN s.taxa_alfabetizacao IS NULL THEN 'Sem evento streaming'
              WHEN b.meta_ano IS NULL THEN 'Sem meta para o ano'
              WHEN s.taxa_alfabetizacao >= b.meta_ano THEN 'Meta atingida' ELSE 'Abaixo da meta' END
           AS status_meta_streaming,
         CASE WHEN s.evento_id IS NOT NULL AND b.{key} IS NOT NULL THEN 'Correspondente'
              WHEN s.evento_id IS NOT NULL THEN 'Somente streaming' ELSE 'Somente batch' END AS status_correspondencia,
         b.status_integracao AS status_integracao_batch, 'Batch + Streaming' AS origem_integracao
  FROM (SELECT * FROM current_events WHERE nivel = '{level}') s FULL OUTER JOIN {integ} b
    ON s.ano_referencia = CAST(b.ano AS INTEGER) AND s.{key} = CAST(b.{key} AS VARCHAR))"""


HYB_STATE = hybrid_sql("hyb_state", "UF", "integ_state")
HYB_CITY = hybrid_sql("hyb_city", "Municipio", "integ_city")
HYB_ALL = "hyb_all AS (SELECT * FROM hyb_state UNION ALL SELECT * FROM hyb_city)"
PANEL = f"""panel AS (
  SELECT *, {band_sql("taxa_streaming", False)} AS faixa_desempenho_streaming,
         {rnd("abs(taxa_streaming - taxa_batch)")} AS desvio_absoluto_batch
  FROM hyb_all WHERE evento_id IS NOT NULL)"""
HYBRID_CTES = [*BOTH_BASE, INTEG_STATE, INTEG_CITY, *EVENT_CTES, HYB_STATE, HYB_CITY, HYB_ALL]

LITERACY_TEXT = "translate(lower(trim(coalesce(alfabetizado, ''))), 'ãáàâéêíóôõúç', 'aaaaeeiooouc')"
LITERACY = (f"CASE WHEN {LITERACY_TEXT} IN ('sim', '1', 'true', 'alfabetizado', 'alfabetizada') OR "
            f"(contains({LITERACY_TEXT}, 'alfabetiz') AND NOT contains({LITERACY_TEXT}, 'nao')) THEN 1 ELSE 0 END")
VALID_W = "proficiencia IS NOT NULL AND peso_aluno > 0"

SUMMARY = f"""summary AS (
  SELECT ano, id_municipio, CAST(NULL AS VARCHAR) AS id_municipio_nome, serie, rede,
         count(DISTINCT id_aluno) AS total_alunos, count(DISTINCT id_escola) AS total_escolas,
         CAST(sum(CASE WHEN alfabetizado IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS alunos_com_classificacao,
         CAST(sum({LITERACY}) AS BIGINT) AS alunos_alfabetizados,
         CASE WHEN count(proficiencia) > 0 THEN {half_up("sum(proficiencia)", "count(proficiencia)")} END
           AS media_proficiencia,
         CASE WHEN sum(CASE WHEN alfabetizado IS NOT NULL THEN 1 ELSE 0 END) > 0 THEN
           {rnd(pct(f"sum({LITERACY})", "sum(CASE WHEN alfabetizado IS NOT NULL THEN 1 ELSE 0 END)"))} END
           AS taxa_alfabetizacao_calculada,
         CASE WHEN coalesce(sum(CASE WHEN {VALID_W} THEN peso_aluno END), 0) > 0 THEN
           {half_up(f"sum(CASE WHEN {VALID_W} THEN proficiencia * peso_aluno END)",
                    f"sum(CASE WHEN {VALID_W} THEN peso_aluno END)")} END AS media_proficiencia_ponderada
  FROM v_students GROUP BY ano, id_municipio, serie, rede)"""

IND_STATE = f"ind_state AS ({indicators_sql('results_state', 'sigla_uf', 'sigla_uf_nome', 'ranking_uf')})"
IND_CITY = f"ind_city AS ({indicators_sql('results_city', 'id_municipio', 'id_municipio_nome', 'ranking_municipio')})"
TARGETS_PANEL = f"""targets_panel AS (
  SELECT * FROM (
    {targets_long_sql("v_target_country", "Brasil", {})}
    UNION ALL
    {targets_long_sql("targets_state", "UF", STATE_PANEL_COLS)}
    UNION ALL
    {targets_long_sql("targets_city", "Município", CITY_PANEL_COLS)}
  ) WHERE meta_alfabetizacao IS NOT NULL)"""

DICT_FOR = "(SELECT chave, valor FROM v_dictionary WHERE id_tabela = '{t}' AND nome_coluna = '{c}')"

RAW_RESULTS = """raw_results AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS ano, CAST(c.c_nationkey AS VARCHAR) AS k,
         o.o_orderstatus AS serie, c.c_mktsegment AS rede,
         CAST(100 AS DOUBLE) * count_if(o.o_orderpriority = '1-URGENT') / count(*) AS taxa_alfabetizacao,
         CAST(count(*) AS DOUBLE) AS media_portugues
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2, 3, 4)"""


def ingest_results_sql(key: str, name: str) -> str:
    shares = ", ".join(f"CAST(NULL AS DOUBLE) AS {s}" for s in SHARES)
    return with_(V_DICTIONARY, DIRECTORY, RAW_RESULTS) + f"""
SELECT r.ano, r.k AS {key}, d.nome AS {name}, ds.valor AS serie, dr.valor AS rede, r.taxa_alfabetizacao,
       r.media_portugues, {shares}
FROM raw_results r LEFT JOIN directory d ON r.k = d.sigla
  LEFT JOIN {DICT_FOR.format(t='orders', c='o_orderstatus')} ds ON r.serie = ds.chave
  LEFT JOIN {DICT_FOR.format(t='orders', c='c_mktsegment')} dr ON r.rede = dr.chave"""


def ingest_targets_sql(key: str | None, name: str | None, extra_int: list[str]) -> str:
    metas = ", ".join(f"t.meta_{y}" for y in YEARS)
    extras = "".join(f"CAST(NULL AS INTEGER) AS {e}, " for e in extra_int)
    if key is None:
        return with_(V_TARGET_COUNTRY) + f"""
SELECT t.ano, CAST(NULL AS VARCHAR) AS rede, t.taxa_alfabetizacao, {metas}, {extras}
       CAST(NULL AS DOUBLE) AS percentual_participacao
FROM v_target_country t"""
    return with_(V_TARGET, DIRECTORY) + f"""
SELECT t.ano, t.local_id AS {key}, d.nome AS {name}, CAST(NULL AS VARCHAR) AS rede, t.taxa_alfabetizacao, {metas},
       {extras}CAST(NULL AS DOUBLE) AS percentual_participacao
FROM v_target t LEFT JOIN directory d ON t.local_id = d.sigla"""


ORACLE: dict[str, str] = {}

# cleaning
ORACLE["clean_strings"] = with_(V_RAW) + "SELECT * FROM raw_clean"
ORACLE["fix_types"] = with_(V_RAW) + """
SELECT CAST(TRY_CAST(ano AS DOUBLE) AS INTEGER) AS ano, serie, id_aluno, id_escola,
       TRY_CAST(replace(taxa_alfabetizacao, ',', '.') AS DOUBLE) AS taxa_alfabetizacao,
       CAST(TRY_CAST(nivel_alfabetizacao AS DOUBLE) AS INTEGER) AS nivel_alfabetizacao FROM v_raw_strings"""
ORACLE["require_columns"] = with_(V_RAW) + \
    "SELECT * FROM raw_clean WHERE ano IS NOT NULL AND id_aluno IS NOT NULL AND serie IS NOT NULL"
ORACLE["dedup_by_keys"] = with_(V_RAW) + """
SELECT ano, serie, id_aluno, id_escola, taxa_alfabetizacao, nivel_alfabetizacao FROM (
  SELECT *, row_number() OVER (PARTITION BY ano, id_aluno, id_escola
                               ORDER BY serie ASC NULLS LAST, taxa_alfabetizacao ASC NULLS LAST,
                                          nivel_alfabetizacao ASC NULLS LAST) AS rn
  FROM raw_fixed) WHERE rn = 1"""
ORACLE["null_out_of_range"] = with_(V_RAW) + """
SELECT CAST(TRY_CAST(ano AS DOUBLE) AS INTEGER) AS ano, serie, id_aluno, id_escola,
       CASE WHEN t BETWEEN 0 AND 100 THEN t END AS taxa_alfabetizacao,
       CAST(TRY_CAST(nivel_alfabetizacao AS DOUBLE) AS INTEGER) AS nivel_alfabetizacao
FROM (SELECT *, TRY_CAST(replace(taxa_alfabetizacao, ',', '.') AS DOUBLE) AS t FROM v_raw_strings)"""
ORACLE["clean_table"] = with_(V_RAW) + """
SELECT ano, serie, id_aluno, id_escola,
       CASE WHEN taxa_alfabetizacao BETWEEN 0 AND 100 THEN taxa_alfabetizacao END AS taxa_alfabetizacao,
       nivel_alfabetizacao, 'raw_strings' AS fonte_tabela
FROM raw_dedup"""

# ingestion
ORACLE["dictionary_decode"] = with_(V_DICTIONARY) + f"""
SELECT l.l_orderkey, l.l_linenumber, d1.valor AS l_returnflag, d2.valor AS l_linestatus
FROM lineitem l LEFT JOIN {DICT_FOR.format(t='lineitem', c='l_returnflag')} d1 ON l.l_returnflag = d1.chave
  LEFT JOIN {DICT_FOR.format(t='lineitem', c='l_linestatus')} d2 ON l.l_linestatus = d2.chave"""
ORACLE["directory_lookup"] = with_(DIRECTORY) + """
SELECT c.c_custkey, CAST(c.c_nationkey AS VARCHAR) AS c_nationkey, d.nome AS nome_nacao
FROM customer c LEFT JOIN directory d ON CAST(c.c_nationkey AS VARCHAR) = d.sigla"""
ORACLE["ingest_results_state"] = ingest_results_sql("sigla_uf", "sigla_uf_nome")
ORACLE["ingest_results_city"] = ingest_results_sql("id_municipio", "id_municipio_nome")
ORACLE["ingest_target_state"] = ingest_targets_sql("sigla_uf", "sigla_uf_nome", [])
ORACLE["ingest_target_country"] = ingest_targets_sql(None, None, [])
ORACLE["ingest_target_city"] = ingest_targets_sql("id_municipio", "id_municipio_nome", ["nivel_alfabetizacao"])
ORACLE["ingest_students"] = with_(V_DICTIONARY, DIRECTORY) + f"""
SELECT CAST(year(l.l_shipdate) AS INTEGER) AS ano, CAST(c.c_nationkey AS VARCHAR) AS id_municipio,
       d.nome AS id_municipio_nome, CAST(l.l_suppkey AS VARCHAR) AS id_escola, CAST(l.l_orderkey AS VARCHAR) AS id_aluno,
       CAST(NULL AS VARCHAR) AS caderno, ds.valor AS serie, c.c_mktsegment AS rede, CAST(NULL AS VARCHAR) AS presenca,
       CAST(NULL AS VARCHAR) AS preenchimento_caderno, da.valor AS alfabetizado,
       l.l_extendedprice AS proficiencia, l.l_quantity - 5 AS peso_aluno
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN directory d ON CAST(c.c_nationkey AS VARCHAR) = d.sigla
  LEFT JOIN {DICT_FOR.format(t='lineitem', c='l_linestatus')} ds ON l.l_linestatus = ds.chave
  LEFT JOIN {DICT_FOR.format(t='lineitem', c='l_returnflag')} da ON l.l_returnflag = da.chave"""

# integration
ORACLE["integrate_state"] = with_(*STATE_BASE, INTEG_STATE) + "SELECT * FROM integ_state"
ORACLE["integrate_city"] = with_(*CITY_BASE, INTEG_CITY) + "SELECT * FROM integ_city"
_CASE_YEAR = "CASE {e} " + " ".join(f"WHEN {y} THEN meta_{y}" for y in YEARS) + " END"
ORACLE["target_for_year"] = with_(*STATE_BASE) + f"""
SELECT ano, sigla_uf, {_CASE_YEAR.format(e="ano")} AS meta_ano, {_CASE_YEAR.format(e="ano + 1")} AS meta_ano_seguinte
FROM targets_state"""
ORACLE["match_status"] = with_(*CITY_BASE, INTEG_CITY) + \
    "SELECT status_integracao, count(*) AS linhas FROM integ_city GROUP BY status_integracao"
ORACLE["target_gap"] = with_(*STATE_BASE, INTEG_STATE) + \
    f"SELECT ano, sigla_uf, serie, gap_para_meta_ano, gap_para_meta_{FINAL} FROM integ_state"

# gold
ORACLE["performance_band"] = with_(*STATE_BASE) + \
    f"SELECT ano, sigla_uf, serie, rede, {band_sql('taxa_alfabetizacao')} AS faixa_desempenho FROM results_state"
ORACLE["adequate_share"] = with_(*STATE_BASE) + """
SELECT ano, sigla_uf, serie, rede,
       CAST(0 AS DOUBLE) + coalesce(proporcao_aluno_nivel_5, CAST(0 AS DOUBLE))
         + coalesce(proporcao_aluno_nivel_6, CAST(0 AS DOUBLE)) + CAST(0 AS DOUBLE) + CAST(0 AS DOUBLE)
         AS proporcao_niveis_adequados
FROM results_state"""
ORACLE["indicators_state"] = with_(*STATE_BASE) + indicators_sql("results_state", "sigla_uf", "sigla_uf_nome",
                                                                  "ranking_uf")
ORACLE["indicators_city"] = with_(*CITY_BASE) + indicators_sql("results_city", "id_municipio", "id_municipio_nome",
                                                                "ranking_municipio")
ORACLE["comparison_status"] = with_(*STATE_BASE, INTEG_STATE) + \
    f"SELECT ano, sigla_uf, serie, status_comparacao FROM ({compare_sql('integ_state', 'sigla_uf', 'sigla_uf_nome', 'ranking_uf', [])})"
ORACLE["compare_state"] = with_(*STATE_BASE, INTEG_STATE) + compare_sql("integ_state", "sigla_uf", "sigla_uf_nome",
                                                                        "ranking_uf", [])
ORACLE["compare_city"] = with_(*CITY_BASE, INTEG_CITY) + compare_sql("integ_city", "id_municipio", "id_municipio_nome",
                                                                     "ranking_municipio", ["nivel_alfabetizacao"])
ORACLE["targets_long"] = with_(*STATE_BASE) + targets_long_sql("targets_state", "UF", STATE_PANEL_COLS)
ORACLE["panel_status"] = with_(*CITY_BASE) + \
    f"SELECT ano_referencia, ano_meta, id_municipio, status_meta FROM ({targets_long_sql('targets_city', 'Município', CITY_PANEL_COLS)})"
ORACLE["targets_panel"] = with_(*BOTH_BASE, V_TARGET_COUNTRY, TARGETS_PANEL) + "SELECT * FROM targets_panel"
ORACLE["literacy_flag"] = with_(V_STUDENTS) + \
    f"SELECT id_aluno, id_escola, alfabetizado, {LITERACY} AS alfabetizado_flag FROM v_students"
ORACLE["student_summary"] = with_(V_STUDENTS, SUMMARY) + "SELECT * FROM summary"
ORACLE["weighted_mean"] = with_(V_STUDENTS) + f"""
SELECT ano, rede,
       CASE WHEN coalesce(sum(CASE WHEN {VALID_W} THEN peso_aluno END), 0) > 0 THEN
         {half_up(f"sum(CASE WHEN {VALID_W} THEN proficiencia * peso_aluno END)",
                  f"sum(CASE WHEN {VALID_W} THEN peso_aluno END)")} END AS media_proficiencia_ponderada
FROM v_students GROUP BY ano, rede"""

# events
_LEVEL = "CASE WHEN event_type IN ('view', 'click') THEN 'UF' WHEN event_type = 'error' THEN 'X' ELSE 'Municipio' END"
_NETWORK = ("CASE event_type WHEN 'view' THEN ' Municipalizada' WHEN 'purchase' THEN 'PUBLICA estadual ' WHEN 'click' THEN NULL "
            "ELSE concat(' ', event_type) END")
ORACLE["normalize_network"] = f"""
SELECT event_id, {_LEVEL} AS nivel, {normalize_network_sql(_LEVEL, _NETWORK)} AS rede FROM events"""
ORACLE["flatten_events"] = with_(V_EVENTS, FLAT) + "SELECT * FROM flat"
ORACLE["validate_events"] = with_(V_EVENTS, FLAT, VALIDATED) + "SELECT * FROM validated"
ORACLE["rejected_events"] = with_(V_EVENTS, FLAT, VALIDATED) + "SELECT * FROM validated WHERE motivo_rejeicao <> ''"
ORACLE["latest_event"] = with_(*EVENT_CTES[:4]) + "SELECT * FROM deduped"
ORACLE["latest_per_place"] = with_(*EVENT_CTES) + "SELECT * FROM current_events"
ORACLE["quality_metrics"] = with_(V_EVENTS, FLAT, VALIDATED) + """
SELECT total AS total_recebidos, valid AS validos_antes_dedup, final AS validos_finais, total - valid AS rejeitados,
       valid - final AS duplicados_removidos
FROM (SELECT count(*) AS total, CAST(count_if(motivo_rejeicao = '') AS BIGINT) AS valid,
             count(DISTINCT CASE WHEN motivo_rejeicao = '' THEN evento_id END) AS final FROM validated)"""
ORACLE["stream_target_status"] = with_(*STATE_BASE, INTEG_STATE, *EVENT_CTES, HYB_STATE) + \
    "SELECT ano_referencia, sigla_uf, serie, evento_id, status_meta_streaming FROM hyb_state"
ORACLE["hybrid_state"] = with_(*STATE_BASE, INTEG_STATE, *EVENT_CTES, HYB_STATE) + "SELECT * FROM hyb_state"
ORACLE["hybrid_city"] = with_(*CITY_BASE, INTEG_CITY, *EVENT_CTES, HYB_CITY) + "SELECT * FROM hyb_city"
ORACLE["hybrid_all"] = with_(*HYBRID_CTES) + "SELECT * FROM hyb_all"
ORACLE["hybrid_panel"] = with_(*HYBRID_CTES, PANEL) + "SELECT * FROM panel"

# audits
ORACLE["hybrid_view"] = with_(*HYBRID_CTES, PANEL) + f"""
SELECT nivel, nome_localidade, ano_referencia, {rnd("taxa_batch")} AS taxa_batch,
       {rnd("taxa_streaming")} AS taxa_streaming, {rnd("meta_ano")} AS meta_ano, variacao_streaming_vs_batch,
       gap_streaming_para_meta, status_meta_streaming, status_correspondencia
FROM panel ORDER BY nivel ASC NULLS FIRST, nome_localidade ASC NULLS FIRST"""
ORACLE["table_counts"] = with_(*HYBRID_CTES, PANEL) + """
SELECT 'eventos_streaming' AS tabela, count(*) AS registros FROM deduped
UNION ALL SELECT 'integrado_batch_streaming', count(*) FROM hyb_all
UNION ALL SELECT 'painel_hibrido_atual', count(*) FROM panel"""
_CMP_STATE = f"cmp_state AS ({compare_sql('integ_state', 'sigla_uf', 'sigla_uf_nome', 'ranking_uf', [])})"
_CMP_CITY = f"cmp_city AS ({compare_sql('integ_city', 'id_municipio', 'id_municipio_nome', 'ranking_municipio', ['nivel_alfabetizacao'])})"
ORACLE["match_audit"] = with_(*BOTH_BASE, INTEG_STATE, INTEG_CITY, _CMP_STATE, _CMP_CITY) + """
SELECT 'UF' AS nivel, count(*) AS total, CAST(count_if(status_integracao = 'Correspondente') AS BIGINT) AS correspondencias,
       CAST(count_if(status_integracao = 'Somente resultado') AS BIGINT) AS somente_resultado,
       CAST(count_if(status_integracao = 'Somente meta') AS BIGINT) AS somente_meta
FROM cmp_state
UNION ALL
SELECT 'Município', count(*), CAST(count_if(status_integracao = 'Correspondente') AS BIGINT),
       CAST(count_if(status_integracao = 'Somente resultado') AS BIGINT), CAST(count_if(status_integracao = 'Somente meta') AS BIGINT)
FROM cmp_city"""
ORACLE["key_overlap"] = with_(*BOTH_BASE) + f""",
ur AS (SELECT DISTINCT ano, sigla_uf FROM results_state WHERE rede = '{STATE_NET}'),
um AS (SELECT DISTINCT ano, sigla_uf FROM targets_state),
mr AS (SELECT DISTINCT ano, id_municipio FROM results_city WHERE rede = '{CITY_NET}'),
mm AS (SELECT DISTINCT ano, id_municipio FROM targets_city)
SELECT 'UF' AS nivel,
       CAST(count_if(r.sigla_uf IS NOT NULL AND m.sigla_uf IS NOT NULL) AS BIGINT) AS correspondencias,
       CAST(count_if(r.sigla_uf IS NOT NULL AND m.sigla_uf IS NULL) AS BIGINT) AS somente_resultado,
       CAST(count_if(r.sigla_uf IS NULL AND m.sigla_uf IS NOT NULL) AS BIGINT) AS somente_meta
FROM ur r FULL OUTER JOIN um m ON r.ano = m.ano AND r.sigla_uf = m.sigla_uf
UNION ALL
SELECT 'Município',
       CAST(count_if(r.id_municipio IS NOT NULL AND m.id_municipio IS NOT NULL) AS BIGINT),
       CAST(count_if(r.id_municipio IS NOT NULL AND m.id_municipio IS NULL) AS BIGINT),
       CAST(count_if(r.id_municipio IS NULL AND m.id_municipio IS NOT NULL) AS BIGINT)
FROM mr r FULL OUTER JOIN mm m ON r.ano = m.ano AND r.id_municipio = m.id_municipio"""
ORACLE["rows_per_year"] = with_(*BOTH_BASE) + f"""
SELECT 'resultado_uf' AS origem, ano, count(*) AS registros FROM results_state WHERE rede = '{STATE_NET}' GROUP BY ano
UNION ALL SELECT 'meta_uf', ano, count(*) FROM targets_state GROUP BY ano
UNION ALL SELECT 'resultado_municipio', ano, count(*) FROM results_city WHERE rede = '{CITY_NET}' GROUP BY ano
UNION ALL SELECT 'meta_municipio', ano, count(*) FROM targets_city GROUP BY ano
ORDER BY origem, ano"""
ORACLE["gold_counts"] = with_(*BOTH_BASE, V_TARGET_COUNTRY, IND_STATE, IND_CITY, TARGETS_PANEL, V_STUDENTS,
                              SUMMARY) + """
SELECT 'indicadores_uf' AS tabela, count(*) AS registros FROM ind_state
UNION ALL SELECT 'indicadores_municipio', count(*) FROM ind_city
UNION ALL SELECT 'painel_metas', count(*) FROM targets_panel
UNION ALL SELECT 'resumo_alunos_municipio', count(*) FROM summary"""
ORACLE["gold_sample"] = with_(*STATE_BASE, IND_STATE) + """
SELECT * FROM ind_state
ORDER BY ano ASC NULLS FIRST, sigla_uf ASC NULLS FIRST, serie ASC NULLS FIRST, rede ASC NULLS FIRST LIMIT 10"""
ORACLE["quality_checks"] = with_(*EVENT_CTES[:4]) + """
SELECT 'evento_id_nulo' AS teste, CAST(count_if(evento_id IS NULL) AS BIGINT) AS problemas FROM deduped
UNION ALL SELECT 'timestamp_nulo', CAST(count_if(timestamp_evento IS NULL) AS BIGINT) FROM deduped
UNION ALL SELECT 'taxa_fora_intervalo', CAST(count_if(NOT (taxa_alfabetizacao BETWEEN 0 AND 100)) AS BIGINT) FROM deduped
UNION ALL SELECT 'evento_id_duplicado', count(*) FROM (
  SELECT evento_id FROM deduped GROUP BY evento_id HAVING count(*) > 1)"""

ORACLE["key_multiplicity"] = with_(*STATE_BASE) + f"""
SELECT * FROM (
  SELECT r.ano, r.sigla_uf, r.n AS linhas_esquerda, t.n AS linhas_direita, r.n * t.n AS pares
  FROM (SELECT ano, sigla_uf, count(*) AS n FROM results_state WHERE rede = '{STATE_NET}' GROUP BY ALL) r
  JOIN (SELECT ano, sigla_uf, count(*) AS n FROM targets_state GROUP BY ALL) t
    ON r.ano = t.ano AND r.sigla_uf = t.sigla_uf) WHERE pares > 1"""

# streams: same results as their batch twins
ORACLE["stream_landing"] = ORACLE["flatten_events"]
ORACLE["stream_latest_event"] = ORACLE["latest_event"]
ORACLE["stream_hybrid"] = ORACLE["hybrid_panel"]
ORACLE["stream_first_event"] = with_(*EVENT_CTES[:4]) + "SELECT evento_id, CAST(1 AS BIGINT) AS versoes FROM deduped"
# each message comes twice; the faults follow from its id, and bodies that are cut or in brackets are no objects
ORACLE["landing_metrics"] = """
SELECT CAST(2 * count(*) AS BIGINT) AS recebidas, CAST(count_if(good) AS BIGINT) AS salvas,
       CAST(count_if(good) AS BIGINT) AS repetidas, CAST(2 * count_if(NOT good) AS BIGINT) AS falhas,
       CAST(count_if(good) AS BIGINT) AS documentos
FROM (SELECT event_id % 11 = 0 OR (event_id % 13 <> 0 AND event_id % 17 <> 0) AS good FROM events)"""


def _profile(name: str, src: str, cols: str) -> str:
    n = len(cols.split(","))
    return (f"SELECT '{name}' AS tabela, 'ok' AS status, CAST(NULL AS VARCHAR) AS erro, (SELECT count(*) FROM {src}) AS linhas, "
            f"CAST({n} AS INTEGER) AS colunas, '{cols}' AS nomes_colunas, "
            f"(SELECT string_agg(y, ',' ORDER BY y) FROM (SELECT DISTINCT CAST(ano AS VARCHAR) AS y FROM {src} "
            f"WHERE ano IS NOT NULL)) AS anos")


ORACLE["table_profile"] = with_(*STATE_BASE, V_STUDENTS) + "\nUNION ALL\n".join([
    _profile("resultado_uf", "results_state", "ano,sigla_uf_nome,serie,rede,taxa_alfabetizacao,media_portugues,"
             "proporcao_aluno_nivel_5,proporcao_aluno_nivel_6,sigla_uf"),
    _profile("meta_uf", "targets_state", "ano,sigla_uf_nome,taxa_alfabetizacao," + META_COLS.replace(" ", "")
             + ",sigla_uf"),
    _profile("alunos", "v_students", "ano,id_municipio,id_escola,id_aluno,serie,rede,alfabetizado,proficiencia,"
             "peso_aluno"),
])

# sources and sinks: what was written is what the adapters give
ORACLE["sql_source"] = "SELECT o_orderstatus, count(*) AS linhas FROM orders GROUP BY o_orderstatus"
ORACLE["csv_bronze"] = with_(V_RAW) + "SELECT * FROM v_raw_strings"
ORACLE["json_bronze"] = ORACLE["validate_events"]
ORACLE["row_limit"] = "SELECT least(count(*), 1000) AS linhas FROM lineitem"
ORACLE["catalog_table"] = with_(*STATE_BASE) + "SELECT * FROM results_state"
ORACLE["partitioned_parquet"] = with_(*STATE_BASE) + "SELECT * FROM targets_state"
ORACLE["rejected_sink"] = with_(V_EVENTS, FLAT, VALIDATED) + \
    "SELECT motivo_rejeicao, count(*) AS linhas FROM validated WHERE motivo_rejeicao <> '' GROUP BY 1"
ORACLE["metrics_sink"] = f"SELECT m.* FROM ({ORACLE['quality_metrics']}) m, range(2)"
ORACLE["skip_if_exists"] = with_(*STATE_BASE) + "SELECT * FROM results_state"
ORACLE["incremental_integration"] = ORACLE["integrate_state"]


def _years(source: str) -> str:
    return f"coalesce((SELECT string_agg(CAST(ano AS VARCHAR), ',' ORDER BY ano) FROM (SELECT DISTINCT ano FROM ({source}))), '')"


def _reads(run: int, results: str, targets: str) -> str:
    both = f"SELECT ano FROM results_state WHERE {results} UNION ALL SELECT ano FROM targets_state WHERE {targets}"
    return " UNION ALL ".join([
        *(f"SELECT {run} AS execucao, '{name}' AS tabela, (SELECT count(*) FROM {source} WHERE {these}) AS linhas_lidas, "
          f"{_years(f'SELECT ano FROM {source} WHERE {these}')} AS anos"
          for name, source, these in (("resultado_uf", "results_state", results), ("meta_uf", "targets_state", targets))),
        f"SELECT {run}, 'integrado_uf', NULL, {_years(both)}"])


ORACLE["incremental_reads"] = with_(*STATE_BASE) + " UNION ALL ".join([
    _reads(1, "ano < 1996", "true"), _reads(2, "false", "false"), _reads(3, "ano >= 1996", "false")])


def _manifest(name: str, src: str, status: str, n: int) -> str:
    return (f"SELECT '{name}' AS tabela, '{status}' AS status, false AS com_erro, (SELECT count(*) FROM {src}) AS linhas, "
            f"CAST({n} AS INTEGER) AS colunas, (SELECT string_agg(DISTINCT CAST(ano AS VARCHAR), ',' ORDER BY "
            f"CAST(ano AS VARCHAR)) FROM {src}) AS anos")


ORACLE["ingest_manifest"] = with_(*STATE_BASE, V_STUDENTS) + "\nUNION ALL\n".join([
    _manifest("resultado_uf", "results_state", "ok", 9), _manifest("meta_uf", "targets_state", "existente", 11),
    _manifest("alunos", "v_students", "ok", 9),
    "SELECT 'ausente', 'erro', true, CAST(NULL AS BIGINT), CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR)"])

_SILVER = {"resultado_uf": "results_state", "resultado_municipio": "results_city", "meta_uf": "targets_state", "meta_municipio": "targets_city"}
ORACLE["silver_tables"] = with_(*BOTH_BASE) + " UNION ALL ".join(
    f"SELECT '{name}' AS tabela, count(*) AS linhas, count(DISTINCT ano) AS anos, '{name}' AS fonte FROM {source}"
    for name, source in _SILVER.items()) + """
UNION ALL SELECT 'meta_brasil', count(DISTINCT year(l_shipdate)), count(DISTINCT year(l_shipdate)), 'meta_brasil' FROM lineitem
UNION ALL SELECT 'alunos', count(*), count(DISTINCT ano), 'alunos' FROM (
  SELECT DISTINCT year(l_shipdate) AS ano, c_nationkey, l_suppkey, l_orderkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""
ORACLE["job_guards"] = """
SELECT 'vazio' AS caso, 'NoEventsError' AS erro, CAST(0 AS BIGINT) AS rejeitados, CAST(0 AS BIGINT) AS contados
UNION ALL SELECT 'rejeitados', 'AllRejectedError', count(*), count(*) FROM events"""

ORACLE["student_summary_bitmap"] = ORACLE["student_summary"]

# the audits' SQL texts give what their DataFrame forms give
for _name in ("hybrid_view", "table_counts", "match_audit", "key_overlap", "rows_per_year", "gold_counts", "gold_sample", "quality_checks"):
    ORACLE[f"sql_{_name}"] = ORACLE[_name]
