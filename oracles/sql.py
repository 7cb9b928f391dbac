"""SQL counterparts of the registered queries, written from the dataset rules.

Every oracle is one DuckDB statement: the named parts it needs as common table
expressions, then its own SELECT. Value lists come from the shared constants.
"""

from __future__ import annotations

from importlib import resources

from cohortloom import reference_data as ref

SEED = 42
MODEL = "plantilla_local"
RULE = "v1-implementada-sin-validacion-clinica"


# --- small text helpers ---
def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def arr(values) -> str:
    return "[" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in values) + "]"


def dig(*parts: str) -> str:
    return "sha256(" + " || '|' || ".join(f"({p})::varchar" for p in parts) + ")"


def w(h: str, k: int | str = 0) -> str:
    start = str(8 * k + 1) if isinstance(k, int) else f"(8 * ({k}) + 1)"
    return f"CAST('0x' || substr({h}, {start}, 8) AS BIGINT)"


def u(h: str, k: int | str = 0) -> str:
    return f"({w(h, k)} / 4294967296.0::double)"


def between(draw: str, low, high) -> str:
    return f"({low} + floor({draw} * (({high}) - ({low}) + 1)))::int"


def pick(draw: str, values) -> str:
    return f"list_extract({arr(values)}, (floor({draw} * {len(values)}) + 1)::int)"


def tenth(x: str) -> str:
    return f"(floor(({x}) * 10.0::double + 0.5::double) / 10.0::double)"


def real(draw: str, low: str, high: str) -> str:
    return f"(({low})::double + (({high})::double - ({low})::double) * {draw})"


PARTS: dict[str, tuple[list[str], str]] = {}


def part(name: str, needs: list[str], sql: str) -> None:
    PARTS[name] = (needs, sql)


def statement(needs: list[str], sql: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for other in PARTS[name][0]:
            visit(other)
        ordered.append(name)

    for name in needs:
        visit(name)
    ctes = ",\n".join(f"{name} AS ({PARTS[name][1]})" for name in ordered)
    return f"WITH {ctes}\n{sql}" if ctes else sql


# --- calibration and geography as value lists ---
part("calibracion", [], "SELECT * FROM (VALUES " + ", ".join(
    f"({at}, {q(m)}, {q(p)}, {lo}, {hi}, {arr(pool)}::varchar[], {rate}::double)"
    for at, (m, p, lo, hi, pool, rate) in enumerate(ref.CALIBRATION)
) + ") t(orden, modulo_synthea, procedimiento, edad_min, edad_max, pool, p_complicacion)")

part("geo", [], """
  SELECT departamento, ciudad, poblacion, poblacion / total::double AS peso,
         (acumulado - poblacion) / total::double AS desde,
         CASE WHEN acumulado = total THEN 1.0::double ELSE acumulado / total::double END AS hasta
  FROM (SELECT *, sum(poblacion) OVER () AS total, sum(poblacion) OVER (ORDER BY orden) AS acumulado
        FROM (VALUES """ + ", ".join(
    f"({at}, {q(d)}, {q(c)}, {n}::bigint)" for at, (d, c, n) in enumerate(ref.DEPARTMENTS)
) + ") t(orden, departamento, ciudad, poblacion))")


# --- patients, trajectories, cases for one entity table ---
def population(suffix: str, table: str, key: str) -> None:
    part(f"perfiles{suffix}", ["calibracion"], f"""
      SELECT e.pid AS paciente_id, 'bundle_' || e.pid AS bundle_id, '{ref.RUNTIME_TAG}' AS synthea_runtime,
             c.modulo_synthea, c.procedimiento,
             (DATE '{ref.FIRST_SURGERY_DATE}' + {between(u('d', 3), 0, 180)})::varchar AS fecha_cirugia,
             {between(u('d', 0), 'c.edad_min', 'c.edad_max')} AS edad,
             {pick(u('d', 1), ['F', 'M'])} AS genero,
             array_to_string(list_filter(c.pool, lambda item, pos: {u('d', 'pos + 3')} < 0.25::double), ',')
               AS comorbilidades,
             {u('d', 2)} < c.p_complicacion AS complicacion_encounter
      FROM (SELECT {key} AS i, printf('pac_{SEED}_%05d', {key}) AS pid,
                   {dig("'perfil_paciente'", f"printf('pac_{SEED}_%05d', {key})", str(SEED))} AS d FROM {table}) e
      JOIN calibracion c ON c.orden = e.i % 5""")

    part(f"arquetipos{suffix}", [f"perfiles{suffix}"], f"""
      SELECT paciente_id,
             CASE WHEN complicacion_encounter THEN 'complicacion_real'
                  WHEN {u(dig("'trayectoria_arquetipo'", 'paciente_id', str(SEED)))} < 0.5::double
                  THEN 'recuperacion_normal' ELSE 'complicacion_leve_vigilancia' END AS arq
      FROM perfiles{suffix}""")

    part(f"llamadas{suffix}", [f"arquetipos{suffix}"], f"""
      SELECT *, idx / 3.0::double AS p, 1.0::double - abs(idx / 3.0::double - 0.5::double) * 2.0::double AS pico,
             {dig("'trayectoria_dia'", 'paciente_id', 'dia', str(SEED))} AS d
      FROM arquetipos{suffix}, (VALUES (0, 1), (1, 3), (2, 7), (3, 14)) dias(idx, dia)""")

    part(f"senales{suffix}", [f"llamadas{suffix}"], f"""
      SELECT *, arq = 'complicacion_real' AND idx >= 2 AS rojo,
             list_extract(['fiebre', 'dolor', 'herida', 'movilidad'], (floor({u('d', 6)} * 4) + 1)::int) AS bandera,
             {u('d', 0)} AS u0, {u('d', 1)} AS u1, {u('d', 2)} AS u2, {u('d', 3)} AS u3, {u('d', 4)} AS u4, {u('d', 5)} AS u5
      FROM llamadas{suffix}""")

    normal, mild = "arq = 'recuperacion_normal'", "arq = 'complicacion_leve_vigilancia'"
    part(f"trayectorias{suffix}", [f"senales{suffix}"], f"""
      SELECT 'tray_' || paciente_id || '_' || dia AS trayectoria_id, paciente_id, dia AS dia_postop,
        arq AS arquetipo_trayectoria,
        CASE WHEN {normal} AND idx = 3 THEN {between('u0', 0, 2)}
             WHEN {normal} THEN {between('u0', 0, 'greatest(2, round_even(6 - 5 * p, 0))')}
             WHEN {mild} THEN least(7, {between('u0', 2, '4 + round_even(3 * pico, 0)')})
             WHEN rojo AND bandera = 'dolor' THEN 9
             WHEN rojo THEN {between('u0', 5, 7)}
             ELSE {between('u0', 3, '4 + round_even(4 * p, 0)')} END::int AS dolor_nrs,
        {tenth(f'''CASE WHEN {normal} AND idx = 3 THEN {real('u1', '36.0', '36.9')}
             WHEN {normal} THEN {real('u1', '36.2', '37.4::double - 0.3::double * p')}
             WHEN {mild} THEN least(38.2::double, {real('u1', '36.8', '37.6::double + 0.5::double * pico')})
             WHEN rojo AND bandera = 'fiebre' THEN {real('u1', '38.5', '39.5')}
             WHEN rojo THEN {real('u1', '37.8', '38.4')}
             ELSE {real('u1', '37.0', '37.5::double + 1.0::double * p')} END''')} AS fiebre_c,
        CASE WHEN {normal} AND p >= 0.6 THEN 'normal'
             WHEN {normal} THEN {pick('u2', ['limitada_esperada', 'limitada_esperada', 'normal'])}
             WHEN {mild} THEN {pick('u2', ['normal', 'limitada_esperada'])}
             WHEN rojo AND bandera = 'movilidad' THEN 'incapacitante_nueva'
             ELSE {pick('u2', ['limitada_esperada', 'normal'])} END AS movilidad,
        CASE WHEN {normal} AND p >= 0.4 THEN 'normal'
             WHEN {normal} THEN {pick('u3', ['normal', 'normal', 'normal', 'eritema_leve'])}
             WHEN {mild} AND pico > 0.3 THEN {pick('u3', ['normal', 'eritema_leve'])}
             WHEN {mild} THEN 'normal'
             WHEN rojo AND bandera = 'herida' THEN {pick('u3', ['dehiscencia', 'secrecion_purulenta'])}
             WHEN rojo THEN 'eritema_leve'
             ELSE {pick('u3', ['normal', 'eritema_leve'])} END AS herida,
        CASE WHEN {normal} AND p >= 0.5 THEN 'normal'
             WHEN {normal} THEN {pick('u4', ['levemente_disminuido', 'normal'])}
             WHEN {mild} AND pico > 0.4 THEN {pick('u4', ['normal', 'levemente_disminuido', 'muy_disminuido'])}
             WHEN {mild} THEN 'normal'
             WHEN rojo THEN 'muy_disminuido'
             ELSE {pick('u4', ['levemente_disminuido', 'muy_disminuido'])} END AS apetito,
        CASE WHEN {normal} AND p >= 0.5 THEN 'normal'
             WHEN {normal} THEN {pick('u5', ['levemente_alterado', 'normal'])}
             WHEN {mild} AND pico > 0.4 THEN {pick('u5', ['normal', 'levemente_alterado', 'muy_alterado'])}
             WHEN {mild} THEN 'normal'
             WHEN rojo THEN 'muy_alterado'
             ELSE {pick('u5', ['levemente_alterado', 'muy_alterado'])} END AS sueno,
        {SEED} AS seed
      FROM senales{suffix}""")

    part(f"casos{suffix}", [f"trayectorias{suffix}"], f"""
      SELECT 'caso_' || trayectoria_id AS caso_id, paciente_id, trayectoria_id, dia_postop,
             dolor_nrs, fiebre_c, movilidad, herida, apetito, sueno, {TRIAGE} AS label, '{RULE}' AS regla_version
      FROM trayectorias{suffix}""")

    part(f"adaptados{suffix}", ["geo"], f"""
      SELECT p.paciente_id,
             {pick(u('n', 0), ref.FIRST_NAMES)} || ' ' || {pick(u('n', 1), ref.SURNAMES)} || ' '
               || {pick(u('n', 2), ref.SURNAMES)} AS nombre_completo,
             {pick(u('n', 3), ref.STREET_KINDS)} || ' ' || {between(u('n', 4), 1, 170)} || ' # '
               || {between(u('n', 5), 1, 120)} || '-' || {between(u('n', 6), 1, 99)} AS direccion,
             g.ciudad, g.departamento,
             (900000000 + {between(u('d', 1), 0, 99999999)})::varchar AS documento_cc,
             {pick(u('d', 2), ref.INSURERS)} AS eps, 'US' AS source_country, 'CO' AS adapted_country,
             {q(','.join(ref.ADAPTED_FIELDS))} AS adaptation_fields
      FROM (SELECT *, {dig("'adapt_colombia'", 'paciente_id', str(SEED))} AS d,
                   {dig("'adapt_colombia_nombre'", 'paciente_id', str(SEED))} AS n
            FROM (SELECT printf('pac_{SEED}_%05d', {key}) AS paciente_id FROM {table})) p
      JOIN geo g ON {u('d', 0)} >= g.desde AND {u('d', 0)} < g.hasta""")


TRIAGE = """CASE
    WHEN fiebre_c IS NULL OR isnan(fiebre_c) THEN NULL
    WHEN fiebre_c >= 38.5::double OR herida IN ('dehiscencia', 'secrecion_purulenta') OR dolor_nrs >= 8
         OR movilidad = 'incapacitante_nueva' THEN 'rojo'
    WHEN (fiebre_c >= 37.8::double)::int + (dolor_nrs >= 5)::int + (herida = 'eritema_leve')::int
         + (apetito = 'muy_disminuido')::int + (sueno = 'muy_alterado')::int >= 2 THEN 'amarillo'
    ELSE 'verde' END"""

population("", "orders", "o_orderkey")

ESTILO = pick(u(dig("'dialogo_estilo'", "caso_id", str(SEED))), ref.STYLES)

part("contexto_cl", ["casos", "perfiles", "adaptados"], f"""
  SELECT c.*, p.procedimiento, p.edad, a.nombre_completo, a.ciudad, {ESTILO} AS estilo_paciente
  FROM casos c JOIN perfiles p USING (paciente_id) JOIN adaptados a USING (paciente_id)""")

# --- generated dialogues ---
_LEVELS = {
    "dolor": "CASE WHEN dolor_nrs >= 8 THEN 4 WHEN dolor_nrs >= 5 THEN 3 WHEN dolor_nrs >= 3 THEN 2 ELSE 1 END",
    "fiebre": "CASE WHEN fiebre_c >= 38.0::double THEN 3 WHEN fiebre_c >= 37.5::double THEN 2 ELSE 1 END",
    "movilidad": f"list_position({arr(ref.MOBILITY)}, movilidad)",
    "herida": f"list_position({arr(ref.WOUND)}, herida)",
    "apetito": f"list_position({arr(ref.APPETITE)}, apetito)",
    "sueno": f"list_position({arr(ref.SLEEP)}, sueno)",
}


def _turn_text(at: int, area: str) -> str:
    n = w("dp", at)
    return f"""
      SELECT *, {2 * at} AS turno_idx, 'agente' AS hablante,
             list_extract({arr(ref.QUESTIONS[area])}, ({n} % 3 + 1)::int) AS texto FROM con_d
      UNION ALL
      SELECT *, {2 * at + 1}, 'paciente',
             list_extract({arr(ref.OPENINGS)},
               ((list_position({arr(ref.STYLES)}, estilo_paciente) - 1) * 2 + ({n} // 3) % 2 + 1)::int) || ' ' ||
             list_extract({arr(ref.ANSWERS[area])}, (({_LEVELS[area]}) * 2 + ({n} // 6) % 2 + 1)::int) FROM con_d"""


part("con_d", ["contexto_cl"],
     f"SELECT *, {dig(q('dialogo_plantilla'), 'caso_id', str(SEED))} AS dp FROM contexto_cl")
part("turnos_cl", ["con_d"], " UNION ALL ".join(_turn_text(at, area) for at, area in enumerate(ref.AREAS)))
part("medidos_cl", ["turnos_cl"], """
  SELECT *, len(string_split(texto, ' ')) AS palabras, turno_idx // 2 AS area FROM turnos_cl""")
# Words of each message counted once per later turn whose history holds it.
part("tokens_cl", ["medidos_cl"], """
  SELECT caso_id, sum(palabras)::int AS completion_tokens,
         (5 * 21 + sum(CASE WHEN hablante = 'agente' THEN palabras * ((5 - area) + (6 - area))
                            ELSE palabras * (5 - area) END))::int AS prompt_tokens
  FROM medidos_cl GROUP BY caso_id""")
part("capa1_cl", ["turnos_cl", "tokens_cl"], f"""
  SELECT 'dlg_' || t.caso_id || '_' || turno_idx AS dialogo_id, t.caso_id, paciente_id, dia_postop, turno_idx,
         hablante, texto, label AS label_ground_truth, estilo_paciente, '{MODEL}' AS modelo_paciente,
         '{MODEL}' AS modelo_agente,
         CASE WHEN hablante = 'paciente' THEN k.prompt_tokens END AS prompt_tokens,
         CASE WHEN hablante = 'paciente' THEN k.completion_tokens END AS completion_tokens
  FROM turnos_cl t JOIN tokens_cl k ON t.caso_id = k.caso_id""")

# --- conversations as layer 1 ---
part("capa1", [], f"""
  SELECT 'dlg_conv_' || conv_id || '_' || turn AS dialogo_id, 'conv_' || conv_id AS caso_id,
         printf('pac_{SEED}_%05d', conv_id) AS paciente_id, 0 AS dia_postop, turn::int AS turno_idx,
         CASE role WHEN 'user' THEN 'paciente' WHEN 'assistant' THEN 'agente' ELSE role END AS hablante, text AS texto,
         {pick(u('d', 0), ref.LABELS)} AS label_ground_truth, {pick(u('d', 1), ref.STYLES)} AS estilo_paciente,
         '{MODEL}' AS modelo_paciente, '{MODEL}' AS modelo_agente, conv_id
  FROM (SELECT *, {dig(q('conversacion'), 'conv_id', str(SEED))} AS d FROM conversations)""")


# --- noise ---
def chosen(source: str, level: str) -> str:
    """``tipo`` per row of ``source``, null when not affected."""
    eligible = [[n for n, lo, hi in ref.NOISE_RANGES if lo <= i <= hi] for i in range(1, 6)]
    lists = "[" + ", ".join(arr(e) for e in eligible) + "]"
    return f"""
      SELECT *, CASE WHEN {level} BETWEEN 1 AND 5 AND {u('ds', 0)} < least(0.9::double, 0.15::double * {level})
                     THEN list_extract(lista, (floor({u('ds', 1)} * len(lista)) + 1)::int) END AS tipo
      FROM (SELECT *, {dig(q('inject_noise_seleccion'), 'dialogo_id', str(SEED))} AS ds,
                   list_extract({lists}, {level}) AS lista FROM {source})"""


def stt(text: str, level: int, key: str) -> str:
    p = f"least(0.9::double, 0.06::double * {level})"
    word_key = dig(key, "(pos - 1) // 8")
    cut_key = dig(key, "'corte'", "pos - 1")
    return f"""array_to_string(list_transform(string_split({text}, ' '), lambda w, pos:
      CASE WHEN w <> '' AND {u(word_key, '(pos - 1) % 8')} < {p} THEN
        CASE WHEN length(w) > 3 AND {u(cut_key, 0)} < 0.5::double
             THEN substr(w, 1, (2 + floor({u(cut_key, 1)} * (length(w) - 2)))::int) || '-'
             ELSE '{ref.INAUDIBLE}' END
      ELSE w END), ' ')"""


def idiom(text: str, level: int, key: str, entries: dict[str, str]) -> str:
    allowed = min(len(entries), 1 + level // 2)
    state = f"{{'t': {text}, 'n': 0}}"
    items = ", ".join(f"{{'t': {q(a)}, 'n': {at}}}" for at, a in enumerate(entries))
    draw = (lambda at: u(key, at) if at < 7 else u(dig(key, str((at + 1) // 8)), (at + 1) % 8))  # word 7 draws the filler
    draws = f"list_extract([{', '.join(draw(at) for at in range(len(entries)))}], e.n + 1)"
    idioms_list = arr(list(entries.values()))
    folded = f"""list_reduce(list_concat([{state}], [{items}]), lambda s, e:
      CASE WHEN s.n < {allowed} AND contains(lower(s.t), e.t)
                AND {draws} < 0.5::double + 0.1::double * {level}
           THEN {{'t': replace(s.t, e.t, list_extract({idioms_list}, e.n + 1)), 'n': s.n + 1}}
           ELSE s END)"""
    return f"""list_extract(list_transform([{folded}], lambda r:
      CASE WHEN r.n = 0 THEN r.t || ' ' || {pick(u(key, 7), ref.IDIOM_FALLBACK)} ELSE r.t END), 1)"""


def noise_key(text: str, kind: str, level: str) -> str:
    return dig(q("inject_noise_udf"), text, kind, level, str(SEED))


def noise_parts(suffix: str, source: str) -> None:
    part(f"elegidos{suffix}", [source], chosen(source, "3"))
    part(f"anotados{suffix}", [f"elegidos{suffix}"], f"""
      SELECT *, CASE tipo
          WHEN 'cambio_interlocutor' THEN {pick(u('ds', 2), ref.INTERJECTIONS)}
          WHEN 'ruido_stt' THEN {stt('texto', 3, 'dk')}
          WHEN 'modismo_regional' THEN {idiom('texto', 3, 'dk', ref.IDIOMS)}
          WHEN 'respuesta_ambigua' THEN texto || ' ... ' || {pick(u('dk', 0), ref.AMBIGUOUS)}
          WHEN 'contradiccion' THEN texto || ' ' || {pick(u('dk', 0), ref.CONTRADICTIONS)}
          WHEN 'informacion_faltante' THEN {pick(u('dk', 0), ref.FILLERS)} END AS ruidoso
      FROM (SELECT *, {noise_key('texto', "coalesce(tipo, '')", '3')} AS dk FROM elegidos{suffix})""")
    part(f"registro{suffix}", [f"anotados{suffix}"], f"""
      SELECT 'map_' || id2 || '_' || turno_idx || '_' || tipo AS mapping_id, dialogo_id AS dialogo_id_capa1,
             id2 AS dialogo_id_capa2, turno_idx AS turno_idx_afectado, tipo AS tipo_ruido, 3 AS intensidad,
             texto AS texto_original, ruidoso AS texto_ruidoso, {SEED} AS seed
      FROM (SELECT *, dialogo_id || CASE WHEN tipo = 'cambio_interlocutor' THEN '_c2_tercero' ELSE '_c2' END AS id2
            FROM anotados{suffix} WHERE tipo IS NOT NULL)""")


noise_parts("", "capa1")
noise_parts("_cl", "capa1_cl")

def layer2_part(suffix: str) -> None:
    part(f"capa2{suffix}", [f"anotados{suffix}"], f"""
  SELECT dialogo_id, dialogo_id_capa1, caso_id, paciente_id, dia_postop,
         (row_number() OVER (PARTITION BY caso_id, dia_postop ORDER BY antes, insertado) - 1)::int AS turno_idx,
         hablante, texto, label_ground_truth, estilo_paciente, modelo_paciente, modelo_agente, intensidad_ruido
  FROM (
    SELECT dialogo_id || '_c2' AS dialogo_id, dialogo_id AS dialogo_id_capa1, caso_id, paciente_id, dia_postop,
           turno_idx AS antes, 0 AS insertado, hablante,
           CASE WHEN tipo IS NULL OR tipo = 'cambio_interlocutor' THEN texto ELSE ruidoso END AS texto,
           label_ground_truth, estilo_paciente, modelo_paciente, modelo_agente,
           CASE WHEN tipo <> 'cambio_interlocutor' THEN 3 END AS intensidad_ruido
    FROM anotados{suffix}
    UNION ALL
    SELECT dialogo_id || '_c2_tercero', dialogo_id, caso_id, paciente_id, dia_postop, turno_idx, 1, 'tercero', ruidoso,
           label_ground_truth, estilo_paciente, modelo_paciente, modelo_agente, 3
    FROM anotados{suffix} WHERE tipo = 'cambio_interlocutor')""")


layer2_part("")
layer2_part("_cl")

part("cambios", ["capa2"], """
  SELECT CASE WHEN hablante = 'tercero' THEN dialogo_id ELSE dialogo_id_capa1 END AS dialogo_id, caso_id, turno_idx,
         hablante, texto, label_ground_truth
  FROM capa2 WHERE intensidad_ruido IS NOT NULL""")

# --- edge-case submissions ---


def nth(values, index: str) -> str:
    return f"list_extract({arr(values)}, (({index}) % {len(values)} + 1)::int)"


part("envios", [], f"""
  SELECT k, 'envio_' || k AS envio_id, 'limite_' || k AS caso_id, printf('pac_{SEED}_%05d', k) AS paciente_id,
         {nth([1, 3, 7, 14], 'k')} AS dia_postop, {nth([*ref.EDGE_CATEGORIES, 'otra'], 'k')} AS categoria_caso_limite,
         CASE WHEN k % 7 = 1 THEN '' WHEN k % 7 > 1 THEN 'revision_' || (k % 3) END AS validado_por,
         CASE WHEN k % 11 = 0 THEN '' WHEN k % 11 > 1 THEN 'criterio_' || (k % 4) END AS criterio_clinico_ref,
         {nth(ref.LABELS, 'k')} AS label_ground_truth, k % 6 <> 0 AS con_sintomas,
         (k % 11)::int AS dolor_nrs, 36.0::double + (k % 36) / 10.0::double AS fiebre_c,
         {nth(ref.MOBILITY, 'k')} AS movilidad, {nth(ref.WOUND, 'k')} AS herida, {nth(ref.APPETITE, 'k')} AS apetito,
         {nth(ref.SLEEP, 'k // 3')} AS sueno, nombre
  FROM (SELECT c_custkey AS k, c_name AS nombre FROM customer)""")
part("revisados", ["envios"], f"""
  SELECT *, CASE WHEN categoria_caso_limite = 'otra' THEN 'categoria_caso_limite'
                 WHEN validado_por IS NULL OR validado_por = '' THEN 'validado_por'
                 WHEN criterio_clinico_ref IS NULL OR criterio_clinico_ref = '' THEN 'criterio_clinico_ref' END AS motivo,
         CASE WHEN con_sintomas THEN {TRIAGE} END AS label_regla
  FROM envios""")
part("capa3_todo", ["revisados"], """
  SELECT 'lim_' || k || '_' || t AS dialogo_id, caso_id, paciente_id, dia_postop, t::int AS turno_idx,
         CASE WHEN t % 2 = 0 THEN 'agente' ELSE 'paciente' END AS hablante, 'Turno ' || t || ' de ' || nombre AS texto,
         label_ground_truth, 'n/a' AS estilo_paciente, 'curado_manual' AS modelo_paciente,
         'curado_manual' AS modelo_agente, categoria_caso_limite, validado_por, criterio_clinico_ref, motivo
  FROM (SELECT *, unnest(range(0, k % 3 + 2)) AS t FROM revisados)""")
part("capa3", ["capa3_todo"], "SELECT * EXCLUDE (motivo) FROM capa3_todo WHERE motivo IS NULL")

# --- planted violations ---
part("capa1_f", ["capa1"], """
  SELECT * EXCLUDE (texto), CASE WHEN conv_id % 17 = 0 AND turno_idx = 1 THEN '   ' ELSE texto END AS texto
  FROM capa1 WHERE NOT (hablante = 'agente' AND conv_id % 13 = 0)""")
part("registro_f", ["registro"],
     f"SELECT * FROM registro WHERE {w(dig(q('omitir'), 'dialogo_id_capa1'))} % 10 <> 0")
part("capa2_f", ["capa2"], f"""
  SELECT * REPLACE (CASE WHEN sorteo = 0 THEN 'desconocido' ELSE label_ground_truth END AS label_ground_truth,
                    CASE WHEN sorteo = 1 THEN intensidad_ruido + 3 ELSE intensidad_ruido END AS intensidad_ruido)
  FROM (SELECT *, {w(dig(q('etiqueta'), 'dialogo_id_capa1'))} % 10 AS sorteo FROM capa2)""")
part("adaptados_f", ["adaptados"], """
  SELECT * REPLACE (CASE resto WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN '  ' ELSE eps END AS eps,
                    CASE resto WHEN 4 THEN NULL WHEN 5 THEN 'US' ELSE adapted_country END AS adapted_country)
  FROM (SELECT *, string_split(paciente_id, '_')[3]::bigint % 1000 AS resto FROM adaptados)""")
part("casos_f", ["trayectorias"], f"""
  SELECT *, 'caso_' || trayectoria_id AS caso_id, {TRIAGE} AS label, '{RULE}' AS regla_version
  FROM (SELECT * REPLACE (CASE resto WHEN 7 THEN NULL WHEN 8 THEN 'nan'::double ELSE fiebre_c END AS fiebre_c)
        FROM (SELECT *, string_split(paciente_id, '_')[3]::bigint % 500 AS resto FROM trayectorias))""")

_BLANK = "(texto IS NULL OR NOT regexp_matches(texto, '\\S'))"
part("hablantes", ["capa1_f"], f"""
  SELECT caso_id, bool_or(hablante = 'paciente') AS con_paciente, bool_or(hablante = 'agente') AS con_agente,
         count(*) AS turnos, count(*) FILTER (WHERE {_BLANK}) AS turnos_vacios
  FROM capa1_f GROUP BY caso_id""")
_SOME_NULL = " OR ".join(f"coalesce({c}, '') = ''" for c in ref.ADAPTED_FIELDS)


def shares(source: str, domain: list[str], by: str | None) -> str:
    keys = f"{by}, " if by else ""
    on = f"ON c.{by} = t.{by} AND c.label = d.label" if by else "ON c.label = d.label"
    group = f"GROUP BY {by}" if by else ""
    select_by = f"t.{by}, " if by else ""
    return f"""
      SELECT {select_by}d.orden, d.label, coalesce(c.n, 0) AS n, t.total,
             coalesce(c.n, 0) / t.total::double AS proporcion,
             coalesce(c.n, 0) / t.total::double BETWEEN 0.05::double AND 0.75::double AS en_rango
      FROM (SELECT {keys}count(*) AS total FROM {source} {group}) t
      CROSS JOIN (VALUES {', '.join(f'({at}, {q(v)})' for at, v in enumerate(domain))}) d(orden, label)
      LEFT JOIN (SELECT {keys}label, count(*) AS n FROM {source} GROUP BY {keys}label) c {on}
      WHERE t.total > 0"""


part("balance_dia", ["casos"], shares("casos", ref.LABELS, "dia_postop"))
part("calidades", [], """
  SELECT -1 AS dia_postop, CASE WHEN doc_id % 50 = 0 THEN 'otra' ELSE quality::varchar END AS label FROM labels""")
part("balance_calidad", ["calidades"], shares("calidades", ["0", "1", "2"], "dia_postop"))
part("casos_extranos", ["casos"], "SELECT CASE label WHEN 'verde' THEN 'desconocido' ELSE label END AS label FROM casos")
part("balance_extrano", ["casos_extranos"], shares("casos_extranos", ref.LABELS, None))


def alerts(source: str, key: str, order: str, catalog: str) -> str:
    tenths = "((2000 * n + total) // (2 * total))"
    return f"""
      SELECT 'alerta_{key}_' || (row_number() OVER (ORDER BY {order}) - 1) AS alerta_id,
             'casos_clinicos_etiquetados_balance' AS check_nombre,
             'casos_clinicos_etiquetados: label ''' || label || ''' fuera de rango [5%,75%] ('
               || ({tenths} // 10) || '.' || ({tenths} % 10) || '%)' AS detalle,
             'advertencia' AS severidad, '{catalog}' AS catalog_run
      FROM {source} WHERE NOT en_rango"""


_DAY_ALERTS = alerts("balance_dia", "20260101T000000000000", "dia_postop, orden", "seguimiento")

part("hecho", ["casos"],
     f"SELECT caso_id FROM casos WHERE {u(dig(q('hecho'), 'caso_id'))} < 0.35::double")
part("hecho_cl", ["casos"],
     f"SELECT caso_id FROM casos WHERE {u(dig(q('hecho'), 'caso_id'))} < 0.35::double")
part("pendientes", ["casos", "hecho"],
     "SELECT * FROM casos WHERE caso_id NOT IN (SELECT caso_id FROM hecho)")


def prompt_sql() -> str:
    template = resources.files("cohortloom.resources").joinpath("patient_prompt.md").read_text("utf-8")
    body = template.split("```\n", 1)[1].split("\n```", 1)[0]
    slots = {
        "perfil_colombia.nombre_completo": "nombre_completo", "perfil_colombia.edad": "edad",
        "procedimiento": "procedimiento", "dia_postop": "dia_postop", "estilo_paciente": "estilo_paciente",
        **{f"vector_sintomas.{s}": s for s in ref.SYMPTOMS},
    }
    sql = q(body)
    for name, column in slots.items():
        sql = f"replace({sql}, '{{{{{name}}}}}', {column}::varchar)"
    return sql


part("instrucciones_cl", ["contexto_cl"], f"SELECT caso_id, label, {prompt_sql()} AS prompt FROM contexto_cl")

_PROFILE = "SELECT * FROM perfiles"
_L1 = ("dialogo_id, caso_id, paciente_id, dia_postop, turno_idx, hablante, texto, label_ground_truth, estilo_paciente, "
       "modelo_paciente, modelo_agente")
_EVENT_LABEL = """
  SELECT event_id, event_type, CASE
    WHEN v IS NULL THEN NULL
    WHEN v >= 150.0::double OR (event_type = 'error' AND v >= 60.0::double) THEN 'rojo'
    WHEN (v >= 40.0::double)::int + (event_type IN ('error', 'purchase'))::int + (user_id % 2 = 0)::int >= 2 THEN 'amarillo'
    ELSE 'verde' END AS label
  FROM (SELECT *, CASE WHEN event_id % 97 <> 0 THEN value END AS v FROM events)"""


def contract_counts(source: str, table: str, required: list[str], rules: dict[str, str]) -> str:
    """The key is the first required column."""
    checks = {f"no_nulo:{c}": f"{c} IS NULL" for c in required} | {n: f"NOT ({r})" for n, r in rules.items()}
    counts = [f"SELECT '{table}' AS tabla, '{name}' AS regla, count(*) FILTER (WHERE {bad}) AS n_violaciones FROM {source}"
              for name, bad in checks.items()]
    return " UNION ALL ".join([*counts, f"SELECT '{table}', 'clave_unica:{required[0]}', "
                                        f"count({required[0]}) - count(DISTINCT {required[0]}) FROM {source}"])


_TURN = ["caso_id", "paciente_id", "dia_postop", "turno_idx", "hablante", "texto", "label_ground_truth",
         "estilo_paciente", "modelo_paciente", "modelo_agente"]
_IN_LABELS = "IN ('verde', 'amarillo', 'rojo')"
_CONTRACTS = " UNION ALL ".join([
    contract_counts("(SELECT *, 1 AS generado_ts FROM perfiles, range(1, CASE WHEN string_split(paciente_id, '_')[3]::bigint "
                    "% 400 = 5 THEN 4 ELSE 2 END) copias(copia))", "perfiles_pacientes",
                    ["paciente_id", "bundle_id", "modulo_synthea", "procedimiento", "fecha_cirugia", "edad",
                     "complicacion_encounter", "generado_ts"], {}),
    contract_counts("(SELECT *, 1 AS generado_ts FROM trayectorias)", "trayectorias_postop",
                    ["trayectoria_id", "paciente_id", "dia_postop", "arquetipo_trayectoria", *ref.SYMPTOMS, "seed",
                     "generado_ts"], {}),
    contract_counts("(SELECT *, 1 AS generado_ts FROM avisos)", "alertas_calidad",
                    ["alerta_id", "check_nombre", "detalle", "severidad", "catalog_run", "generado_ts"],
                    {"severidad_valida": "severidad IN ('advertencia', 'bloqueante')"}),
    contract_counts("(SELECT *, 1 AS clasificado_ts FROM casos_f)", "casos_clinicos_etiquetados",
                    ["caso_id", "paciente_id", "trayectoria_id", "dia_postop", *ref.SYMPTOMS, "label", "regla_version",
                     "clasificado_ts"], {"label_valido": f"label {_IN_LABELS}"}),
    contract_counts("(SELECT *, 1 AS adaptation_ts FROM adaptados_f)", "perfiles_pacientes_co",
                    ["paciente_id", "nombre_completo", "direccion", "ciudad", "departamento", "documento_cc", "eps",
                     "source_country", "adapted_country", "adaptation_fields", "adaptation_ts"], {}),
    contract_counts("(SELECT *, 1 AS generado_ts FROM capa1)", "dialogos_capa1_limpia",
                    ["dialogo_id", *_TURN, "generado_ts"],
                    {"label_valido": f"label_ground_truth {_IN_LABELS}",
                     "hablante_valido": "hablante IN ('paciente', 'agente')"}),
    contract_counts("(SELECT *, 1 AS generado_ts FROM capa2_f)", "dialogos_capa2_ruidosa",
                    ["dialogo_id", "dialogo_id_capa1", *_TURN, "generado_ts"],
                    {"label_valido": f"label_ground_truth {_IN_LABELS}",
                     "intensidad_valida": "intensidad_ruido IS NULL OR intensidad_ruido BETWEEN 1 AND 5"}),
    contract_counts("(SELECT *, 1 AS aplicado_ts FROM registro)", "noise_mapping_log",
                    ["mapping_id", "dialogo_id_capa1", "dialogo_id_capa2", "turno_idx_afectado", "tipo_ruido",
                     "intensidad", "texto_original", "texto_ruidoso", "seed", "aplicado_ts"],
                    {"intensidad_valida": "intensidad BETWEEN 1 AND 5"}),
    contract_counts("(SELECT *, 1 AS generado_ts FROM capa3_todo)", "dialogos_capa3_limite",
                    ["dialogo_id", *_TURN, "generado_ts", "categoria_caso_limite", "criterio_clinico_ref"],
                    {"label_valido": f"label_ground_truth {_IN_LABELS}",
                     "categoria_valida": f"categoria_caso_limite IN ({', '.join(q(c) for c in ref.EDGE_CATEGORIES)})"}),
])


def report_row(check: str, severity: str, rows: str, problems: str) -> str:
    return f"SELECT '{check}' AS check_nombre, '{severity}' AS severidad, ({rows})::bigint AS filas, ({problems})::bigint AS problemas"


_N = {t: f"SELECT count(*) FROM {t}" for t in ("adaptados_f", "casos", "capa1_f", "capa2", "capa3_todo")}
_SILENT = ("SELECT DISTINCT dialogo_id FROM capa2 WHERE intensidad_ruido IS NOT NULL "
           "AND dialogo_id NOT IN (SELECT dialogo_id_capa2 FROM registro_f)")
_REPORT = " UNION ALL ".join([
    report_row("perfiles_co_vacia", "bloqueante", _N["adaptados_f"], f"SELECT (({_N['adaptados_f']}) = 0)::int"),
    report_row("perfiles_co_nulos", "bloqueante", _N["adaptados_f"], f"SELECT count(*) FROM adaptados_f WHERE {_SOME_NULL}"),
    report_row("perfiles_co_pais", "bloqueante", _N["adaptados_f"],
               "SELECT count(*) FROM adaptados_f WHERE adapted_country IS DISTINCT FROM 'CO'"),
    report_row("casos_vacia", "bloqueante", _N["casos"], f"SELECT (({_N['casos']}) = 0)::int"),
    report_row("casos_balance", "advertencia", _N["casos"],
               "SELECT count(*) FROM balance_total WHERE NOT en_rango"),
    report_row("capa1_vacia", "advertencia", _N["capa1_f"], f"SELECT (({_N['capa1_f']}) = 0)::int"),
    report_row("capa1_turno_vacio", "bloqueante", _N["capa1_f"], f"SELECT count(*) FROM capa1_f WHERE {_BLANK}"),
    report_row("capa1_un_hablante", "bloqueante", _N["capa1_f"],
               "SELECT count(*) FROM hablantes WHERE NOT (con_paciente AND con_agente)"),
    report_row("capa2_vacia", "advertencia", _N["capa2"], f"SELECT (({_N['capa2']}) = 0)::int"),
    report_row("capa2_cambio_silencioso", "bloqueante", f"SELECT count(*) FROM ({_SILENT})",
               f"SELECT (count(*) > 0)::int FROM ({_SILENT})"),
    report_row("capa3_sin_revisor", "bloqueante", _N["capa3_todo"],
               "SELECT count(*) FROM capa3_todo WHERE coalesce(validado_por, '') = ''"),
])
part("balance_total", ["casos"], shares("casos", ref.LABELS, None))

_VIEW = f"SELECT {_L1}, '{{tag}}' AS capa FROM {{source}}"
_PARTICIPANTS = " UNION ALL ".join([
    _VIEW.format(tag="capa1_limpia", source="capa1"), _VIEW.format(tag="capa2_ruidosa", source="capa2")])
_COMMITTEE = _PARTICIPANTS + " UNION ALL " + _VIEW.format(tag="capa3_limite", source="capa3")

part("avisos", ["balance_dia"], _DAY_ALERTS)
part("eventos", [], f"SELECT e.*, l.label FROM events e JOIN ({_EVENT_LABEL}) l USING (event_id)")
# Two arrivals; the watermark is the latest time of earlier arrivals in whole milliseconds, less the delay.
part("llegadas", ["eventos"], """
  SELECT *, max(CASE WHEN llegada = 1 THEN date_trunc('milliseconds', ts) END) OVER () - INTERVAL 6 HOUR AS marca,
         max(date_trunc('milliseconds', ts)) OVER () - INTERVAL 6 HOUR AS ultima_marca
  FROM (SELECT *, CASE WHEN pronto THEN 1 ELSE 2 END AS llegada, false AS copia FROM (
          SELECT *, event_id <= (SELECT max(event_id) // 2 FROM events) AND event_id % 10 <> 0 AS pronto FROM eventos)
        UNION ALL
        SELECT *, 2, true FROM (
          SELECT *, event_id <= (SELECT max(event_id) // 2 FROM events) AND event_id % 10 <> 0 AS pronto FROM eventos)
        WHERE pronto AND event_id % 7 = 0)""")
part("ventanas", ["llegadas"], """
  SELECT *, inicio + INTERVAL 12 HOUR AS fin, llegada = 1 OR inicio + INTERVAL 12 HOUR > marca AS cuenta
  FROM (SELECT *, time_bucket(INTERVAL 12 HOUR, ts) AS inicio FROM llegadas)""")
part("valores", ["contexto_cl", "perfiles"], """
  SELECT c.caso_id, p.modulo_synthea AS modulo, c.nombre_completo AS nombre, c.edad::varchar AS edad, c.ciudad,
         c.procedimiento, c.dia_postop::varchar AS dia, c.estilo_paciente AS estilo, c.dolor_nrs::varchar AS dolor_nrs,
         c.fiebre_c::varchar AS fiebre_c, c.movilidad, c.herida, c.apetito, c.sueno
  FROM contexto_cl c JOIN perfiles p USING (paciente_id)""")
_VALUE_NAMES = ["nombre", "edad", "ciudad", "procedimiento", "dia", "estilo", *ref.SYMPTOMS]


def rendered(module: str, role: str, template: str) -> str:
    """One template as a concatenation; names in closed double braces are columns of ``valores``."""
    out, missing, rest = [], [], template
    while "{{" in rest and "}}" in rest.split("{{", 1)[1]:
        before, after = rest.split("{{", 1)
        name, rest = after.split("}}", 1)
        out.append(q(before))
        if name.strip() in _VALUE_NAMES:
            out.append(name.strip())
        else:
            missing.append(name.strip())
    text = " || ".join([*out, q(rest)])
    return (f"SELECT caso_id, modulo, '{role}' AS rol, {text} AS prompt, '{','.join(missing)}' AS sin_valor "
            f"FROM valores WHERE modulo = '{module}'")


_UPSERT = """
  SELECT * FROM cambios
  UNION ALL SELECT dialogo_id, caso_id, turno_idx, hablante, texto, label_ground_truth FROM capa1
  WHERE dialogo_id NOT IN (SELECT dialogo_id FROM cambios)"""

_LINEAGE = """
        SELECT r.mapping_id, r.dialogo_id_capa1, r.dialogo_id_capa2, r.tipo_ruido, r.turno_idx_afectado,
               a.turno_idx AS turno_capa1, b.turno_idx AS turno_capa2, a.hablante AS hablante_capa1,
               b.hablante AS hablante_capa2, r.texto_original = a.texto AS original_igual,
               r.texto_ruidoso = b.texto AS ruidoso_igual, a.label_ground_truth = b.label_ground_truth AS label_igual
        FROM registro{suffix} r LEFT JOIN capa1{suffix} a ON a.dialogo_id = r.dialogo_id_capa1
                        LEFT JOIN capa2{suffix} b ON b.dialogo_id = r.dialogo_id_capa2"""

_STORED_L1 = (
    "SELECT * REPLACE (prompt_tokens::varchar AS prompt_tokens, completion_tokens::varchar AS completion_tokens) "
    "FROM capa1_cl")
_STORED_L2 = "SELECT * REPLACE (intensidad_ruido::varchar AS intensidad_ruido) FROM capa2"

CUSTOM_IDIOMS = {"une": "una", "que": "ke", "the": "el", " la ": " lla ", "tion": "ción", "ing": "in", "and": "an",
                 "er": "or", " de ": " di ", "en": "em", "ou": "u"}

ORACLES: dict[str, str] = {
    "seed_parity": statement([], f"""
        SELECT indice, {w('d', 0)} AS semilla, {u('d', 1)} AS u, {between(u('d', 2), 5, 17)} AS entero,
               {pick(u('d', 3), ref.STYLES)} AS eleccion, {pick(u('d', 4), ['a', 'a', 'b'])} AS eleccion_ponderada,
               {u('d', 5)} < 0.3::double AS acierto, {tenth(real(u('d', 6), '36.2', '37.4'))} AS decimal
        FROM (SELECT o_orderkey AS indice, {dig(q('paridad'), 'o_orderkey', str(SEED))} AS d FROM orders)"""),
    "profiles": statement(["perfiles"], _PROFILE),
    "bundle_roundtrip": statement(["perfiles"], "SELECT *, '2026-01-01 00:00:00' AS generado FROM perfiles"),
    "complication_rate": statement(["perfiles"], """
        SELECT modulo_synthea, count(*) AS pacientes, count(*) FILTER (WHERE complicacion_encounter) AS complicados,
               complicados / pacientes::double AS tasa, any_value(p_complicacion) AS p_complicacion,
               abs(complicados / pacientes::double - any_value(p_complicacion)) <= 0.04::double AS en_tolerancia
        FROM perfiles JOIN calibracion USING (modulo_synthea) GROUP BY modulo_synthea"""),
    "comorbidity_rate": statement(["perfiles"], """
        SELECT c.modulo_synthea, c.item AS comorbilidad, count(*) AS pacientes,
               count(*) FILTER (WHERE list_contains(string_split(p.comorbilidades, ','), c.item)) AS con,
               con / pacientes::double AS tasa
        FROM (SELECT modulo_synthea, unnest(pool) AS item FROM calibracion) c JOIN perfiles p USING (modulo_synthea)
        GROUP BY ALL"""),
    "trajectories": statement(["trayectorias"], "SELECT * FROM trayectorias"),
    "archetype_mix": statement(["trayectorias"], """
        SELECT arquetipo_trayectoria, count(DISTINCT paciente_id) AS pacientes FROM trayectorias GROUP BY ALL"""),
    "labelled_cases": statement(["casos"], "SELECT * FROM casos"),
    "rule_label_events": _EVENT_LABEL,
    "incremental_labels": _EVENT_LABEL,
    "label_at_event": statement(["eventos"], """
        SELECT e.event_id, e.user_id, coalesce(f.event_id, -1) AS evento_previo, coalesce(f.label, 'ninguno') AS label_previo
        FROM eventos e ASOF LEFT JOIN (
          SELECT user_id, ts, max(event_id) AS event_id, arg_max(label, event_id) AS label FROM eventos
          WHERE label IS NOT NULL GROUP BY user_id, ts) f ON e.user_id = f.user_id AND e.ts > f.ts"""),
    "red_episodes": statement(["eventos"], """
        SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS inicio, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS fin,
               count(*) AS n, max(r) = max(todas) AS abierto
        FROM (SELECT *, r - row_number() OVER (PARTITION BY user_id, rojo ORDER BY ts, event_id) AS grupo
              FROM (SELECT *, coalesce(label = 'rojo', false) AS rojo, count(*) OVER (PARTITION BY user_id) AS todas,
                           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM eventos))
        WHERE rojo GROUP BY user_id, grupo"""),
    "stream_resume": statement(["llegadas"], """
        SELECT event_id, event_type, label, CASE WHEN llegada = 2 AND ts <= marca THEN 'tarde' ELSE 'a_tiempo' END AS estado
        FROM llegadas WHERE NOT copia"""),
    "windowed_label_share": statement(["ventanas"], f"""
        SELECT strftime(inicio, '%Y-%m-%d %H:%M:%S') AS inicio, d.label, n[d.label] AS n, total, tardias,
               n[d.label] / total::double AS proporcion,
               n[d.label] / total::double BETWEEN 0.05::double AND 0.75::double AS en_rango
        FROM (SELECT inicio, count(*) FILTER (cuenta) AS total, count(*) FILTER (NOT cuenta) AS tardias,
                     map({arr(ref.LABELS)}, [{', '.join(f"count(*) FILTER (cuenta AND label = '{v}')" for v in ref.LABELS)}]) AS n
              FROM ventanas WHERE fin <= ultima_marca GROUP BY inicio HAVING count(*) FILTER (cuenta) > 0),
             (SELECT unnest({arr(ref.LABELS)}) AS label) d"""),
    "distinct_cases_sketch": statement(["casos"], """
        SELECT dia_postop, count(DISTINCT paciente_id) AS exacto, true AS en_error, true AS igual_a_una_pasada
        FROM casos WHERE label <> 'verde' GROUP BY dia_postop
        UNION ALL SELECT -1, count(DISTINCT paciente_id), true, true FROM casos WHERE label <> 'verde'"""),
    "last_call_label": statement(["casos"], """
        SELECT paciente_id, max(dia_postop) AS ultimo_dia, arg_max(label, dia_postop) AS ultimo_label
        FROM casos GROUP BY paciente_id"""),
    "red_persistence": statement(["casos"], """
        SELECT c.paciente_id, coalesce(any_value(primero), -1) AS primer_rojo,
               count(*) FILTER (WHERE label = 'rojo') AS llamadas_rojas,
               coalesce(bool_and(label = 'rojo') FILTER (WHERE dia_postop >= primero), true) AS persistente
        FROM (SELECT *, min(dia_postop) FILTER (WHERE label = 'rojo') OVER (PARTITION BY paciente_id) AS primero
              FROM casos) c GROUP BY c.paciente_id"""),
    "geo_sample": statement(["geo"], f"""
        SELECT indice, departamento, ciudad
        FROM (SELECT o_orderkey AS indice, {u(dig(q('geo'), 'o_orderkey', str(SEED)))} AS x FROM orders)
        JOIN geo ON x >= desde AND x < hasta"""),
    "adapted_profiles": statement(["adaptados"], "SELECT * FROM adaptados"),
    "geo_weights": statement(["adaptados"], """
        SELECT g.departamento, g.ciudad, g.poblacion, g.peso, g.desde, g.hasta, count(a.paciente_id) AS pacientes
        FROM geo g LEFT JOIN adaptados a ON a.departamento = g.departamento GROUP BY ALL"""),
    "geo_distribution": statement(["adaptados"], """
        SELECT count(*) AS pacientes, count(*) FILTER (WHERE departamento = 'Bogotá D.C.') AS n_capital,
               count(DISTINCT departamento) AS departamentos, n_capital / pacientes::double AS proporcion_capital,
               n_capital / pacientes::double < 2.5::double * (SELECT peso FROM geo WHERE departamento = 'Bogotá D.C.')
                 AS concentracion_ok,
               count(DISTINCT departamento) >= 10 AS dispersion_ok
        FROM adaptados"""),
    "case_context": statement(["casos", "perfiles", "adaptados"], """
        SELECT c.caso_id, c.paciente_id, c.dia_postop, c.label, p.procedimiento, a.nombre_completo, a.ciudad, p.edad,
               dolor_nrs, fiebre_c, movilidad, herida, apetito, sueno
        FROM casos c JOIN perfiles p USING (paciente_id) JOIN adaptados a USING (paciente_id)"""),
    "style_mix": statement(["casos"], f"SELECT {ESTILO} AS estilo_paciente, count(*) AS casos FROM casos GROUP BY 1"),
    "patient_prompts": statement(["instrucciones_cl"], "SELECT caso_id, prompt FROM instrucciones_cl"),
    "turn_grid": statement(["casos"], f"""
        SELECT caso_id, dia_postop, turno_idx::int AS turno_idx,
               list_extract({arr(ref.AREAS)}, (turno_idx // 2 + 1)::int) AS area,
               CASE WHEN turno_idx % 2 = 0 THEN 'agente' ELSE 'paciente' END AS hablante
        FROM (SELECT caso_id, dia_postop, unnest(range(12)) AS turno_idx FROM casos)"""),
    "layer1_dialogues": statement(["capa1_cl"], _STORED_L1),
    "turn_history": statement(["capa1_cl"], f"""
        SELECT dialogo_id, turno_idx, hablante,
               CASE WHEN hablante = 'agente' THEN turno_idx + 1 ELSE turno_idx END AS mensajes,
               CASE WHEN hablante = 'agente'
                    THEN coalesce(propias || chr(10), '') || '{ref.AREA_CUE}' || list_extract({arr(ref.AREAS)}, turno_idx // 2 + 1)
                    ELSE todas END AS texto_historial
        FROM (SELECT *, string_agg(texto, chr(10)) OVER antes AS todas,
                     string_agg('{ref.AREA_CUE}' || list_extract({arr(ref.AREAS)}, turno_idx // 2 + 1) || chr(10) || texto, chr(10))
                       FILTER (WHERE hablante = 'agente') OVER antes AS propias
              FROM capa1_cl
              WINDOW antes AS (PARTITION BY caso_id ORDER BY turno_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""),
    "token_totals": statement(["tokens_cl"], "SELECT caso_id, prompt_tokens, completion_tokens FROM tokens_cl"),
    "pending_cases": statement(["pendientes"], "SELECT caso_id, paciente_id, dia_postop, label FROM pendientes"),
    "token_projection": statement(["tokens_cl", "casos", "hecho_cl"], """
        SELECT conversaciones, pendientes, pm AS prompt_medio, cm AS completion_medio, pm * pendientes AS prompt_previsto,
               cm * pendientes AS completion_previsto,
               (pm * pendientes * 3.0::double + cm * pendientes * 15.0::double) / 1000000.0::double AS costo_previsto
        FROM (SELECT count(*) AS conversaciones, (SELECT count(*) FROM casos WHERE caso_id NOT IN (SELECT caso_id FROM hecho_cl)) AS pendientes,
                     sum(prompt_tokens)::bigint / count(*)::double AS pm,
                     sum(completion_tokens)::bigint / count(*)::double AS cm
              FROM tokens_cl WHERE caso_id IN (SELECT caso_id FROM hecho_cl))"""),
    "resume_run": statement(["capa1_cl"], _STORED_L1),
    "upsert_dialogues": statement(["capa1", "cambios"], _UPSERT),
    "upsert_bucketed": statement(["capa1", "cambios"], _UPSERT),
    "label_leak": statement(["instrucciones_cl", "capa1_cl", "capa1"], """
        SELECT fuente, label, count(*) AS textos, count(*) FILTER (WHERE contains(lower(texto), label)) AS con_label
        FROM (SELECT 'prompt_paciente' AS fuente, label, prompt AS texto FROM instrucciones_cl
              UNION ALL SELECT 'turno_' || hablante, label_ground_truth, texto FROM capa1_cl
              UNION ALL SELECT 'conversaciones', label_ground_truth,
                     CASE WHEN turno_idx = 2 THEN texto || ' Caso ' || upper(label_ground_truth) ELSE texto END FROM capa1)
        GROUP BY fuente, label"""),
    "parsed_responses": """
        SELECT conv_id, turn, text AS texto, CASE WHEN turn % 2 = 0 THEN length(text) ELSE 0 END::int AS prompt_tokens,
               CASE WHEN turn % 2 = 0 THEN turn ELSE 0 END::int AS completion_tokens FROM conversations""",
    "parsed_variants": """
        SELECT conv_id, turn, CASE WHEN motivo IS NULL THEN text END AS texto,
               CASE WHEN motivo IS NULL THEN CASE WHEN forma IN (0, 2) THEN length(text) ELSE 0 END END::varchar AS prompt_tokens,
               CASE WHEN motivo IS NULL THEN CASE WHEN forma = 0 THEN turn ELSE 0 END END::varchar AS completion_tokens, motivo
        FROM (SELECT *, CASE WHEN forma = 3 THEN 'json_invalido' WHEN forma = 4 OR text IS NULL THEN 'sin_texto'
                             WHEN forma = 5 THEN 'tokens_invalidos' END AS motivo
              FROM (SELECT *, (conv_id + turn) % 6 AS forma FROM conversations))""",
    "prompts_by_template": statement(["valores"], " UNION ALL ".join(rendered(*t) for t in ref.TEMPLATES)),
    "template_gaps": statement(["valores"], """
        SELECT modulo, 'agente' AS rol, 'tema' AS casilla, count(*) AS casos FROM valores WHERE modulo = 'colorectal_cancer'
        GROUP BY modulo
        UNION ALL SELECT modulo, NULL, NULL, count(*) FROM valores WHERE modulo = 'breast_cancer' GROUP BY modulo"""),
    "guard_outcomes": statement(["capa1"], f"""
        SELECT 'ruido' AS grupo, CASE
            WHEN nivel IS NULL OR nivel NOT BETWEEN 1 AND 5 THEN 'intensidad_invalida'
            WHEN clase = 'cambio_interlocutor' THEN 'tipo_estructural'
            WHEN clase = 'eco' THEN 'tipo_desconocido' ELSE 'pasa' END AS guarda, count(*) AS filas
        FROM (SELECT CASE WHEN conv_id % 11 <> 0 THEN conv_id % 7 END AS nivel,
                     list_extract({arr([n for n, _, _ in ref.NOISE_RANGES] + ['eco'])},
                                  ((turno_idx + conv_id) % {len(ref.NOISE_RANGES) + 1} + 1)::int) AS clase FROM capa1)
        GROUP BY 2
        UNION ALL
        SELECT 'estilo', CASE WHEN n % 13 = 0 OR n % 17 = 0 THEN 'estilo_desconocido' ELSE 'pasa' END, count(*)
        FROM (SELECT turno_idx + conv_id AS n FROM capa1) GROUP BY 2"""),
    "catalogue_gap": """
        SELECT lower(c_mktsegment) AS modulo, count(*) AS filas FROM customer
        WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') GROUP BY 1""",
    "noise_selection": statement(["capa1"], f"""
        SELECT dialogo_id, intensidad, coalesce(tipo, 'ninguno') AS tipo_ruido FROM (
          {chosen('(SELECT dialogo_id, unnest(range(7))::int AS intensidad FROM capa1)', 'intensidad')})"""),
    "noise_stt": f"""
        SELECT doc_id, {stt('texto', 3, 'k')} AS texto_ruidoso
        FROM (SELECT *, {noise_key('texto', "'ruido_stt'", '3')} AS k FROM (
          SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN text || '  doble fin ' ELSE text END AS texto FROM documents))""",
    "noise_idiom": statement(["capa1_cl"], f"""
        SELECT dialogo_id, {idiom('texto', 3, 'k', ref.IDIOMS)} AS texto_ruidoso
        FROM (SELECT *, {noise_key('texto', "'modismo_regional'", '3')} AS k FROM capa1_cl)"""),
    "noise_idiom_custom": statement(["capa1"], f"""
        SELECT dialogo_id, {idiom('texto', 2, 'k', CUSTOM_IDIOMS)} AS texto_ruidoso
        FROM (SELECT *, {noise_key('texto', "'modismo_regional'", '2')} AS k FROM capa1)"""),
    "noise_ambiguous": statement(["capa1"], f"""
        SELECT dialogo_id, i AS intensidad,
               CASE WHEN i >= 4 THEN frase ELSE texto || ' ... ' || frase END AS texto_ruidoso
        FROM (SELECT *, {pick(u(noise_key('texto', "'respuesta_ambigua'", 'i')), ref.AMBIGUOUS)} AS frase
              FROM (SELECT *, turno_idx % 3 + 2 AS i FROM capa1))"""),
    "noise_contradiction": statement(["capa1"], f"""
        SELECT dialogo_id, texto || ' ' || {pick(u(noise_key('texto', "'contradiccion'", '3')), ref.CONTRADICTIONS)}
               AS texto_ruidoso FROM capa1"""),
    "noise_missing": statement(["capa1"], f"""
        SELECT dialogo_id, {pick(u(noise_key('texto', "'informacion_faltante'", '3')), ref.FILLERS)} AS texto_ruidoso
        FROM capa1"""),
    "layer2_dialogues": statement(["capa2"], _STORED_L2),
    "noise_third_party": statement(["capa2"], f"{_STORED_L2} WHERE hablante = 'tercero'"),
    "noise_log": statement(["registro"], "SELECT * FROM registro"),
    "noise_lineage": statement(["registro", "capa1", "capa2"], _LINEAGE.format(suffix="")),
    "noise_lineage_generated": statement(["registro_cl", "capa1_cl", "capa2_cl"], _LINEAGE.format(suffix="_cl")),
    "layer2_generated": statement(["capa2_cl"], _STORED_L2.replace("FROM capa2", "FROM capa2_cl")),
    "noise_summary": statement(["registro_cl"], """
        SELECT coalesce(tipo_ruido, 'TOTAL') AS tipo_ruido, coalesce(intensidad, 0) AS intensidad, nivel::int AS nivel,
               afectados, insertadas, afectados / (SELECT count(*) FROM capa1_cl)::double AS proporcion
        FROM (SELECT tipo_ruido, intensidad, grouping(tipo_ruido, intensidad) AS nivel, count(*) AS afectados,
                     count(*) FILTER (WHERE tipo_ruido = 'cambio_interlocutor') AS insertadas
              FROM registro_cl GROUP BY ROLLUP (tipo_ruido, intensidad))"""),
    "noise_audit": statement(["anotados_cl"], """
        SELECT CASE gid WHEN 7 THEN 'tipo_ruido' WHEN 11 THEN 'hablante' WHEN 13 THEN 'estilo' WHEN 14 THEN 'label'
                        WHEN 6 THEN 'tipo_y_label' ELSE 'total' END AS conjunto,
               coalesce(tipo_ruido, '-') AS tipo_ruido, coalesce(hablante, '-') AS hablante,
               coalesce(estilo_paciente, '-') AS estilo_paciente, coalesce(label_ground_truth, '-') AS label_ground_truth,
               * EXCLUDE (gid, tipo_ruido, hablante, estilo_paciente, label_ground_truth),
               afectados / turnos::double AS proporcion
        FROM (SELECT tipo_ruido, hablante, estilo_paciente, label_ground_truth,
                     grouping(tipo_ruido, hablante, estilo_paciente, label_ground_truth) AS gid,
                     count(*) AS turnos, count(tipo) AS afectados,
                     count(*) FILTER (WHERE tipo = 'cambio_interlocutor') AS insertados,
                     sum(len(string_split(texto, ' ')))::bigint AS palabras,
                     coalesce(sum(len(string_split(ruidoso, ' '))), 0)::bigint AS palabras_ruidosas,
                     coalesce(sum(prompt_tokens) FILTER (WHERE turno_idx = 1), 0)::bigint AS prompt_tokens,
                     coalesce(sum(completion_tokens) FILTER (WHERE turno_idx = 1), 0)::bigint AS completion_tokens
              FROM (SELECT *, coalesce(tipo, 'ninguno') AS tipo_ruido FROM anotados_cl)
              GROUP BY GROUPING SETS ((tipo_ruido), (hablante), (estilo_paciente), (label_ground_truth),
                                      (tipo_ruido, label_ground_truth), ()))"""),
    "unchanged_noise": statement(["registro_cl"], """
        SELECT mapping_id, tipo_ruido, turno_idx_afectado FROM registro_cl WHERE texto_original = texto_ruidoso"""),
    "curated_rows": statement(["capa3"], "SELECT * FROM capa3"),
    "curation_rejects": statement(["revisados"], """
        SELECT envio_id, caso_id, categoria_caso_limite, motivo AS motivo_rechazo FROM revisados WHERE motivo IS NOT NULL"""),
    "rule_disagreement": statement(["revisados"], """
        SELECT envio_id, caso_id, label_ground_truth, label_regla FROM revisados
        WHERE motivo IS NULL AND label_regla <> label_ground_truth"""),
    "demographic_nulls": statement(["adaptados_f"], f"""
        SELECT paciente_id, 'campo_demografico_nulo' AS problema FROM adaptados_f WHERE {_SOME_NULL}
        UNION ALL SELECT paciente_id, 'pais_distinto_de_CO' FROM adaptados_f WHERE adapted_country IS DISTINCT FROM 'CO'"""),
    "label_balance": statement(["balance_dia", "balance_calidad"],
                               "SELECT * FROM balance_dia UNION ALL SELECT * FROM balance_calidad"),
    "blank_turns": statement(["capa1_f"], f"SELECT dialogo_id, caso_id FROM capa1_f WHERE {_BLANK}"),
    "speaker_coverage": statement(["hablantes"], "SELECT * FROM hablantes"),
    "silent_changes": statement(["capa2", "registro_f"], _SILENT),
    "unreviewed_cases": statement(["capa3_todo"], """
        SELECT dialogo_id, caso_id FROM capa3_todo WHERE coalesce(validado_por, '') = ''"""),
    "label_drift": statement(["capa1", "capa2_f"], """
        SELECT a.dialogo_id AS dialogo_id_capa1, b.dialogo_id, b.label_ground_truth AS label_capa2,
               a.label_ground_truth AS label_capa1
        FROM capa2_f b JOIN capa1 a ON a.dialogo_id = b.dialogo_id_capa1
        WHERE a.label_ground_truth <> b.label_ground_truth"""),
    "contract_violations": statement(
        ["perfiles", "trayectorias", "avisos", "casos_f", "adaptados_f", "capa1", "capa2_f", "registro", "capa3_todo"],
        _CONTRACTS),
    "quality_report": statement(
        ["adaptados_f", "casos", "balance_total", "capa1_f", "hablantes", "capa2", "registro_f", "capa3_todo"], _REPORT),
    "alert_rows": statement(["balance_dia"], _DAY_ALERTS),
    "alert_append": statement(
        ["balance_dia", "balance_extrano"],
        f"{_DAY_ALERTS} UNION ALL {alerts('balance_extrano', '20260102T030405678901', 'orden', 'otro')}"),
    "gold_participants": statement(["capa1", "capa2"], _PARTICIPANTS),
    "gold_committee": statement(["capa1", "capa2", "capa3"], _COMMITTEE),
    "gold_roundtrip": statement(["capa1", "capa2", "capa3"], f"""
      SELECT *, 'participantes' AS vista FROM ({_PARTICIPANTS}) UNION ALL SELECT *, 'comite' FROM ({_COMMITTEE})"""),
    "layered_names": statement(["casos"], """
      SELECT unnest(['base', 'vacio']) AS catalogo, dia_postop, count(*) AS n FROM casos WHERE dia_postop = 14
      GROUP BY dia_postop
      UNION ALL SELECT 'otro', dia_postop, count(*) FROM casos WHERE dia_postop = 1 GROUP BY dia_postop"""),
    "audience_leak": statement(["capa1", "capa2", "capa3"], f"""
        SELECT 'participantes' AS vista, count(*) AS filas_capa3_visibles FROM ({_PARTICIPANTS})
        WHERE dialogo_id IN (SELECT dialogo_id FROM capa3)
        UNION ALL SELECT 'comite', count(*) FROM ({_COMMITTEE}) WHERE dialogo_id IN (SELECT dialogo_id FROM capa3)"""),
    "rerun_diff": statement(["capa2"], """
        SELECT count(*)::bigint AS solo_izquierda, count(*)::bigint AS solo_derecha
        FROM (SELECT * FROM capa2 EXCEPT ALL SELECT * FROM capa2)"""),
}
