"""Constant tables and text pools.

FIXED VALUES: the domains, calibration, population figures, insurers, noise
ranges, idioms and noise phrases below define the dataset and have to keep
exactly these values. Names, streets and dialogue phrases are this project's own.
"""

from __future__ import annotations

# --- fixed values: symptom domains, in order of severity ---
WOUND = ["normal", "eritema_leve", "dehiscencia", "secrecion_purulenta"]
MOBILITY = ["normal", "limitada_esperada", "incapacitante_nueva"]
APPETITE = ["normal", "levemente_disminuido", "muy_disminuido"]
SLEEP = ["normal", "levemente_alterado", "muy_alterado"]
ARCHETYPES = ["recuperacion_normal", "complicacion_leve_vigilancia", "complicacion_real"]
SYMPTOMS = ["dolor_nrs", "fiebre_c", "movilidad", "herida", "apetito", "sueno"]
LABELS = ["verde", "amarillo", "rojo"]

# --- fixed values: module, procedure, age range, comorbidity pool, complication rate ---
CALIBRATION = [
    ("appendicitis", "Apendicectomía", 15, 45, [], 0.25),
    ("cholecystitis", "Colecistectomía", 30, 70, ["obesidad", "diabetes_tipo_2", "hipertension"], 0.22),
    ("colorectal_cancer", "Colectomía", 50, 80,
     ["hipertension", "diabetes_tipo_2", "enfermedad_cardiovascular", "epoc"], 0.50),
    ("total_joint_replacement", "Reemplazo de cadera/rodilla", 55, 85,
     ["osteoartritis", "obesidad", "hipertension", "diabetes_tipo_2"], 0.20),
    ("breast_cancer", "Mastectomía", 35, 75, ["ansiedad", "hipertension", "diabetes_tipo_2"], 0.30),
]
COMORBIDITY_RATE = 0.25
FIRST_SURGERY_DATE = "2026-01-05"
SURGERY_DATE_SPAN = 180
RUNTIME_TAG = "synthetic_fallback_sin_pysynthea"
RED_FROM_PROGRESS = 0.5

# --- fixed values: what a call may draw, by archetype ---
# A rule is (attribute, scale, from, below, value). It holds while the scale ("progress", or "peak" = distance
# from both ends of the course) is at least ``from`` and less than ``below``; later rules replace earlier ones.
# Numbers are (constant, slope, least): constant + slope * scale, for pain with the slope's part rounded, and never under ``least``.
# Repeated options are weights.
ALWAYS = (0.0, 9.0)
NOTHING_UNUSUAL = [
    ("pain_cap", "progress", *ALWAYS, (10, 0, 0)),
    ("temp_cap", "progress", *ALWAYS, (100.0, 0, 0)),
    ("mobility", "progress", *ALWAYS, ["normal"]),
    ("wound", "progress", *ALWAYS, ["normal"]),
    ("appetite", "progress", *ALWAYS, ["normal"]),
    ("sleep", "progress", *ALWAYS, ["normal"]),
]
COURSES = {
    "recuperacion_normal": [
        ("pain_low", "progress", *ALWAYS, (0, 0, 0)),
        ("pain_high", "progress", *ALWAYS, (6, -5, 2)),
        ("pain_high", "progress", 1.0, 9.0, (2, 0, 2)),
        ("temp_low", "progress", *ALWAYS, (36.2, 0, 0)),
        ("temp_low", "progress", 1.0, 9.0, (36.0, 0, 0)),
        ("temp_high", "progress", *ALWAYS, (37.4, -0.3, 0)),
        ("temp_high", "progress", 1.0, 9.0, (36.9, 0, 0)),
        ("mobility", "progress", 0.0, 0.6, ["limitada_esperada", "limitada_esperada", "normal"]),
        ("wound", "progress", 0.0, 0.4, ["normal", "normal", "normal", "eritema_leve"]),
        ("appetite", "progress", 0.0, 0.5, ["levemente_disminuido", "normal"]),
        ("sleep", "progress", 0.0, 0.5, ["levemente_alterado", "normal"]),
    ],
    "complicacion_leve_vigilancia": [
        ("pain_low", "peak", *ALWAYS, (2, 0, 0)),
        ("pain_high", "peak", *ALWAYS, (4, 3, 0)),
        ("pain_cap", "peak", *ALWAYS, (7, 0, 0)),
        ("temp_low", "peak", *ALWAYS, (36.8, 0, 0)),
        ("temp_high", "peak", *ALWAYS, (37.6, 0.5, 0)),
        ("temp_cap", "peak", *ALWAYS, (38.2, 0, 0)),
        ("mobility", "peak", *ALWAYS, ["normal", "limitada_esperada"]),
        ("wound", "peak", 0.30000000000000004, 9.0, ["normal", "eritema_leve"]),  # above 0.3
        ("appetite", "peak", 0.4000000000000001, 9.0, APPETITE),  # above 0.4
        ("sleep", "peak", 0.4000000000000001, 9.0, SLEEP),
    ],
    "complicacion_real": [
        ("pain_low", "progress", *ALWAYS, (3, 0, 0)),
        ("pain_high", "progress", *ALWAYS, (4, 4, 0)),
        ("temp_low", "progress", *ALWAYS, (37.0, 0, 0)),
        ("temp_high", "progress", *ALWAYS, (37.5, 1.0, 0)),
        ("mobility", "progress", *ALWAYS, ["limitada_esperada", "normal"]),
        ("wound", "progress", *ALWAYS, ["normal", "eritema_leve"]),
        ("appetite", "progress", *ALWAYS, ["levemente_disminuido", "muy_disminuido"]),
        ("sleep", "progress", *ALWAYS, ["levemente_alterado", "muy_alterado"]),
        ("pain_low", "progress", RED_FROM_PROGRESS, 9.0, (5, 0, 0)),
        ("pain_high", "progress", RED_FROM_PROGRESS, 9.0, (7, 0, 0)),
        ("temp_low", "progress", RED_FROM_PROGRESS, 9.0, (37.8, 0, 0)),
        ("temp_high", "progress", RED_FROM_PROGRESS, 9.0, (38.4, 0, 0)),
        ("wound", "progress", RED_FROM_PROGRESS, 9.0, ["eritema_leve"]),
        ("appetite", "progress", RED_FROM_PROGRESS, 9.0, ["muy_disminuido"]),
        ("sleep", "progress", RED_FROM_PROGRESS, 9.0, ["muy_alterado"]),
    ],
}
# From RED_FROM_PROGRESS on, the serious course has one red sign more.
RED_SIGNS = {
    "fiebre": {"temp_low": (38.5, 0, 0), "temp_high": (39.5, 0, 0)},
    "dolor": {"pain_low": (9, 0, 0), "pain_high": (9, 0, 0)},
    "herida": {"wound": ["dehiscencia", "secrecion_purulenta"]},
    "movilidad": {"mobility": ["incapacitante_nueva"]},
}

# --- fixed values: department, city, population ---
DEPARTMENTS = [
    ("Bogotá D.C.", "Bogotá D.C.", 7937898),
    ("Antioquia", "Medellín", 6951825),
    ("Valle del Cauca", "Cali", 4652512),
    ("Cundinamarca", "Soacha", 3657407),
    ("Atlántico", "Barranquilla", 2845169),
    ("Santander", "Bucaramanga", 2393214),
    ("Bolívar", "Cartagena", 2278770),
    ("Córdoba", "Montería", 1929336),
    ("Nariño", "Pasto", 1719281),
    ("Norte de Santander", "Cúcuta", 1717992),
    ("Cauca", "Popayán", 1590171),
    ("Magdalena", "Santa Marta", 1529038),
    ("Cesar", "Valledupar", 1414859),
    ("Tolima", "Ibagué", 1386826),
    ("Boyacá", "Tunja", 1324122),
    ("Huila", "Neiva", 1205318),
    ("Meta", "Villavicencio", 1160351),
    ("La Guajira", "Riohacha", 1073851),
    ("Caldas", "Manizales", 1051282),
    ("Sucre", "Sincelejo", 1016826),
    ("Risaralda", "Pereira", 974639),
    ("Chocó", "Quibdó", 615082),
    ("Quindío", "Armenia", 568560),
    ("Casanare", "Yopal", 481938),
    ("Caquetá", "Florencia", 430884),
    ("Putumayo", "Mocoa", 393988),
    ("Arauca", "Arauca", 320723),
    ("Vichada", "Puerto Carreño", 127467),
    ("Guaviare", "San José del Guaviare", 103237),
    ("Amazonas", "Leticia", 87480),
    ("San Andrés y Providencia", "San Andrés", 62181),
    ("Guainía", "Inírida", 59240),
    ("Vaupés", "Mitú", 49142),
]

# --- fixed values: insurers, document numbers, replaced fields ---
INSURERS = [
    "Nueva EPS",
    "Sura EPS",
    "Sanitas EPS",
    "Compensar EPS",
    "Famisanar EPS",
    "Salud Total EPS",
    "Coosalud EPS",
    "Aliansalud EPS",
]
DOCUMENT_BASE = 900_000_000
DOCUMENT_SPAN = 99_999_999
ADAPTED_FIELDS = ["nombre_completo", "direccion", "ciudad", "departamento", "documento_cc", "eps"]

# Name and address pools (own choice).
FIRST_NAMES = ["Ana", "Luis", "Marta", "Jorge", "Camila", "Andrés", "Paola", "Diego", "Lucía", "Óscar",
               "Sofía", "Hernán", "Valentina", "Raúl", "Gloria", "Iván"]
SURNAMES = ["Rojano", "Quintero", "Mejía", "Cárdenas", "Ospina", "Beltrán", "Zapata", "Guerrero", "Peña",
            "Salazar", "Nieto", "Urrego", "Acosta", "Villa", "Montoya", "Duarte"]
STREET_KINDS = ["Calle", "Carrera", "Transversal", "Diagonal", "Avenida"]

# --- fixed values: dialogue styles and follow-up areas ---
STYLES = ["colaborativo", "evasivo", "ansioso", "minimizador_sintomas", "confundido"]
AREAS = ["dolor", "fiebre", "movilidad", "herida", "apetito", "sueno"]
AREA_CUE = "Pregunta de seguimiento sobre: "

# --- fixed values: noise type, lowest and highest intensity ---
NOISE_RANGES = [
    ("ruido_stt", 1, 5),
    ("modismo_regional", 1, 3),
    ("respuesta_ambigua", 2, 4),
    ("contradiccion", 3, 5),
    ("informacion_faltante", 2, 5),
    ("cambio_interlocutor", 3, 5),
]
THIRD_PARTY = "cambio_interlocutor"
TEXT_NOISE = [name for name, _, _ in NOISE_RANGES if name != THIRD_PARTY]

# --- fixed values: idioms (applied in this order), their fallback, noise phrases ---
IDIOMS = {
    "mucho dolor": "durísimo",
    "dolor intenso": "un dolor verraco",
    "estoy bien": "estoy bacano",
    "no sé": "no le sé decir",
    "muy mal": "muy jodido",
}
IDIOM_FALLBACK = ["parcero", "pues", "ome"]
AMBIGUOUS = [
    "Pues no sé, más o menos.",
    "Ahí vamos, no le podría decir con seguridad.",
    "Digamos que sí, pero no tanto.",
    "No me acuerdo bien, la verdad.",
    "Puede ser, no estoy seguro.",
]
CONTRADICTIONS = [
    "Espere, en realidad no, creo que sí me duele bastante.",
    "Bueno, eso dije, pero ayer le dije lo contrario.",
    "No, olvide lo que dije, es al revés.",
]
FILLERS = [
    "...",
    "Ay, no sé, se me olvidó lo que iba a decir.",
    "Este... no, nada, siga con la otra pregunta.",
    "[silencio]",
]
INTERJECTIONS = [
    "Perdón, soy la hija, él no escucha muy bien, ¿le puedo ayudar a responder?",
    "Disculpe, soy el cuidador, permítame contarle cómo lo he visto estos días.",
    "Hola, habla la esposa, él está descansando, yo le cuento.",
]
INAUDIBLE = "[inaudible]"

# --- fixed values: edge-case categories and defaults ---
EDGE_CATEGORIES = ["alarma_real", "falso_positivo", "solicitud_diagnostico", "pii_mezclada"]
EDGE_STYLE = "n/a"
EDGE_MODEL = "curado_manual"

# Template generator for dialogue turns (own text). Three questions per area.
QUESTIONS = {
    "dolor": ["¿Cómo ha estado el dolor desde la última llamada?",
              "De cero a diez, ¿cuánto le duele hoy?",
              "Cuénteme si el dolor le cambió en estos días."],
    "fiebre": ["¿Se ha tomado la temperatura?",
               "¿Ha sentido escalofríos o calentura?",
               "¿Qué temperatura le marcó el termómetro hoy?"],
    "movilidad": ["¿Cómo se ha podido mover en la casa?",
                  "¿Camina igual que antes de la cirugía?",
                  "¿Ha podido levantarse sin ayuda?"],
    "herida": ["¿Cómo ve la herida hoy?",
               "¿Le ha salido líquido por la herida?",
               "¿La piel alrededor de la herida se ve igual?"],
    "apetito": ["¿Cómo está comiendo?",
                "¿Le provoca la comida como antes?",
                "¿Ha dejado comidas sin terminar?"],
    "sueno": ["¿Cómo ha dormido?",
              "¿Se despierta mucho en la noche?",
              "¿Descansa bien cuando se acuesta?"],
}
# Two openings per style, in the order of STYLES.
OPENINGS = [
    "Claro que sí, le cuento.", "Con gusto le respondo.",
    "Mire, eso qué importa.", "Ay, mejor hablemos de la cita.",
    "Doctora, estoy preocupado.", "¿Será que eso es normal?",
    "Eso no es nada.", "Yo creo que estoy bien.",
    "Espere, ¿qué me preguntó?", "La verdad no sé qué día fue.",
]
# Per area: two generic answers, then two answers per band or state.
ANSWERS = {
    "dolor": ["No le podría decir cuánto duele.", "Del dolor no sé qué decirle.",
              "Casi no duele, estoy bien.", "Solo siento una molestia pequeña.",
              "Me duele un poco al moverme.", "Duele, pero se aguanta.",
              "Tengo mucho dolor al final del día.", "El dolor no me deja tranquilo.",
              "Es un dolor intenso todo el tiempo.", "Estoy muy mal, tengo mucho dolor."],
    "fiebre": ["No me he tomado la temperatura.", "De la temperatura no sé.",
               "No he tenido calentura.", "El termómetro marca lo de siempre.",
               "He sentido algo de calor.", "Anoche amanecí tibio.",
               "Tengo escalofríos y mucho calor.", "Me siento muy mal con esta calentura."],
    "movilidad": ["No sé cómo explicarle lo del movimiento.", "De moverme no le sé contar.",
                  "Camino como antes.", "Me muevo sin problema.",
                  "Camino despacio y con cuidado.", "Me cuesta levantarme, pero puedo.",
                  "Ya no me puedo parar de la cama.", "Desde ayer no puedo caminar."],
    "herida": ["De la herida no sé decirle.", "No me he mirado la herida.",
               "La herida está seca y limpia.", "La cicatriz se ve bien.",
               "La piel está un poco colorada.", "Se ve un poquito irritada.",
               "Se me abrieron los puntos.", "La herida se abrió por una esquina.",
               "Me sale un líquido con mal olor.", "La gasa amanece con pus."],
    "apetito": ["De la comida no sé qué decir.", "No me he fijado en la comida.",
                "Como igual que siempre.", "Me provoca todo.",
                "Como un poco menos.", "Dejo algo en el plato.",
                "Casi no paso bocado.", "No me provoca nada de comer."],
    "sueno": ["Del sueño no sé decirle.", "No llevo la cuenta de lo que duermo.",
              "Duermo toda la noche.", "Descanso bien.",
              "Me despierto una o dos veces.", "Me cuesta coger el sueño.",
              "No pego el ojo en toda la noche.", "Paso las noches en vela."],
}

# Own prompt templates by module and role; slots are names of the value map.
TEMPLATES = [
    ("appendicitis", "paciente", "Eres {{nombre}}, de {{edad}} años, operado de {{procedimiento}}. Dolor {{dolor_nrs}} de 10. {{estilo}}"),
    ("appendicitis", "agente", "Llamas en el día {{dia}}. Pregunta por la herida y la fiebre."),
    ("cholecystitis", "paciente", "{{nombre}} ({{ciudad}}). Comida: {{apetito}}. Herida: {{herida}}. Habla de modo {{estilo}}."),
    ("cholecystitis", "agente", "Día {{dia}} tras {{procedimiento}}: pregunta qué come y qué le cae mal."),
    ("colorectal_cancer", "paciente", "{{nombre}}, {{edad}}. Fiebre {{fiebre_c}}, sueño {{sueno}}, {{ estilo }}."),
    ("colorectal_cancer", "agente", "Pregunta por {{tema}} y no des consejos a {{nombre}}."),
    ("total_joint_replacement", "paciente", "{{movilidad}} al caminar, dolor {{dolor_nrs}}. {{nombre}} responde."),
    ("total_joint_replacement", "agente", "Día {{dia}}. Pregunta cuánto camina. {sin casilla} {{sin cerrar"),
]
