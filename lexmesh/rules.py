"""Rule tables that drive the operators.

Everything below is fixed values: word lists, patterns, vocabularies and texts that
must be exactly these for right results, in their natural order. One table differs
on purpose: ENTITY_PATTERNS keep whole words at their borders (survey, D-05).
"""

STAGES = ["Integración", "Distribución", "Administración", "Supervisión", "Seguimiento"]
DIMENSIONS = ["Planeación", "Asignación", "Ejecución", "Seguimiento", "Rendición de cuentas"]

STAGE_KEYWORDS = {
    "Integración": ["integración", "integrar", "convenio", "acuerdo de coordinación", "coordinación interinstitucional", "convenios de coordinación", "marco de coordinación", "comisión permanente"],
    "Distribución": ["distribución", "distribuir", "asignación de recursos", "transferencia", "reparto", "cupo", "asignar recursos", "monto asignado", "factor de distribución"],
    "Administración": ["administración", "administrar", "ejercicio", "ejecución del gasto", "operación", "operativo", "gestión administrativa", "ministración", "manejo de recursos"],
    "Supervisión": ["supervisión", "supervisar", "fiscalización", "auditoría", "control", "inspección", "vigilancia", "monitoreo", "verificación", "evaluación del desempeño"],
    "Seguimiento": ["seguimiento", "rendición de cuentas", "transparencia", "informes", "reportes", "indicadores", "sistema de evaluación", "comités de evaluación", "comisión de seguimiento"],
}
DIMENSION_KEYWORDS = {
    "Planeación": ["planeación", "plan", "programación", "anteproyecto", "diagnóstico", "pronóstico", "estrategia"],
    "Asignación": ["asignación", "presupuesto", "recursos", "transferencia", "cupo", "factor de distribución", "monto"],
    "Ejecución": ["ejecución", "operación", "implementación", "aplicación", "ejercicio fiscal", "operativo", "funcionamiento"],
    "Seguimiento": ["seguimiento", "monitoreo", "control", "fiscalización", "auditoría", "supervisión", "indicadores"],
    "Rendición de cuentas": ["rendición de cuentas", "transparencia", "informes", "reportes", "publicación", "acceso a la información", "comprobación", "cuenta pública"],
}

ARTICLE_LINE = r"(?im)^\s*(?:Art(?:ículo|\.)\s+)?(\d+(?:[º°])?(?:\s*(?:bis|ter|quater))?)\s*[\.:]?\s*"
FRACTION_LINE = r"(?m)^\s*([IVX]+|[a-z])\)\s+"
PAGE_ARTICLE = r"(?iu)\n\s*ART[IÍ]CULO\s+(\d+)\s*[o.º°]*"
PAGE_MARK = r"--- Página (\d+) ---"
HEADING_LINE = r"^#{1,6}\s+(.+)$"

LEVELS = [
    ("Federal", r"(?i)\b(Federal|C[ÁM]MARA\s+DE\s+DIPUTADOS|C[ÁM]MARA\s+DE\s+SENADORES|PRESIDENCIA\s+DE\s+LA\s+REP[ÚU]BLICA)\b"),
    ("Estatal", r"(?i)\b(Estatal|GOBIERNO\s+DEL\s+ESTADO|CONGRESO\s+DEL\s+ESTADO)\b"),
    ("Municipal", r"(?i)\b(Municipal|Ayuntamiento)\b"),
]
HIERARCHY = [
    ("CONSTITUCIÓN", "Constitución"), ("REGLAMENTO", "Reglamento"), ("NOM-", "NOM"), ("NORMA OFICIAL MEXICANA", "NOM"), ("LINEAMIENTO", "Lineamiento"),
    ("MANUAL", "Manual"), ("CONVENIO", "Convenio"), ("ACUERDO", "Acuerdo"), ("DECRETO", "Ley"), ("LEY", "Ley"),
]

ENTITY_PATTERNS = [
    ("CARGO", r"\b(President(?:e|a)|Secretari[oa](?:\s+de\s+\w+)?|Subsecretari[oa]|Director(?:a)?(?:\s+General)?|Coordinador(?:a)?(?:\s+General)?|Subprocurador(?:a)?(?:\s+\w+)?|Comisionado(?:a)?(?:\s+\w+)?|Titular|Jefe(?:a)?(?:\s+de\s+\w+)?|Ministr(?:o|a)|Gobernador(?:a)?|Presidente\s+Municipal|Síndico|Regidor(?:a)?)\b"),
    ("NORMA", r"\b(Ley\s+(?:General\s+|Federal\s+|Orgánica\s+)?(?:de\s+(?:los?\s+)?)?[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+(?:\s+[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+){0,5}|Constitución\s+Política\s+de\s+los\s+Estados\s+Unidos\s+Mexicanos|Reglamento\s+(?:de\s+(?:la\s+)?)?[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+(?:\s+[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+){0,4}|NOM[-\s][A-Z0-9\-]+)"),
    ("DOCUMENTO", r"(?i)\b((?:Oficio|Circular|Memorándum|Memorando)\s+(?:No\.?\s*)?[A-Z0-9\-/]+)"),
    ("LUGAR", r"\b(Estados\s+Unidos\s+Mexicanos|Ciudad\s+de\s+México|México|[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+(?:\s+[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+)?(?=\s*,\s*(?:[A-Z][a-z]+|[A-Z]{2})))\b"),
]
ENTITY_TYPES = ["INSTITUCION", "CARGO", "NORMA", "DOCUMENTO", "PERSONA", "LUGAR"]
LAYERS = ["normativo", "operativo", "informal"]

RELEVANCE_PATTERNS = [
    r"\bFASP\b", r"Fondo de Aportaciones para la Seguridad", r"Fondo de Aportaciones", r"Aportaciones Federales", r"Recursos Federales", r"Transferencias Federales", r"Subsidios Federales",
    r"Convenio de Coo?rdinacio?n", r"Anexo Te?cnico", r"Convenios de Coo?rdinacio?n", r"Coordinacio?n Interinstitucional", r"Coordinacio?n Intergubernamental",
    r"Coordinacio?n con (?:la|el) Federacio?n", r"Coordinacio?n con (?:las|los) (?:entidades|municipios|ayuntamientos)", r"Gobernador.*celebr.*acuerdos", r"Gobernador.*celebr.*convenios",
    r"Representacio?n legal del Estado", r"Secretari?a de (Planeacio?n|Finanzas|Gobernacio?n|Seguridad)", r"Secretari?a de Seguridad (?:Ciudadana|Pu?blica)", r"Atribuciones de (?:la|el) Gobernador",
    r"Refrendar.*(?:decretos|acuerdos|reglamentos)", r"plazo de \d+ d[ií]as", r"plazo de \d+ meses", r"dentro de los \d+", r"antes del (?:31|15) de (?:diciembre|marzo|enero)",
    r"Seguridad Pu?blica", r"Prevencio?n del Delito", r"Reclusorio|Penitenciari|Ce?rcar|Reinsencio?n", r"Procuradur[ií]a|Fiscal[ií]a", r"Presupuesto de Egresos",
    r"Programas (?:con|de) Recursos Federales", r"Ejercicio y Control del Presupuesto", r"Rendicio?n de Cuentas", r"Transparencia", r"Sistema Nacional de Seguridad", r"Sistema Estatal de Seguridad",
    r"\bSESNSP\b", r"Secretariado Ejecutivo", r"Consejo (?:Estatal|Nacional) de Seguridad", r"Conferencia Nacional", r"entrada en vigor", r"vigencia", r"publicaci[oó]n",
]
RELEVANCE_LITERALS = [
    "fasp", "fondo de aportaciones", "convenio de coordinacion", "convenio de colaboración", "anexo técnico", "anexo tecnico", "aportaciones federales", "recursos federales", "transferencias federales",
    "ramo 33", "ramo general 33", "celebrar acuerdos", "celebrar convenios", "representación legal", "representacion legal", "refrend", "designar las dependencias", "seguridad pública",
    "seguridad publica", "sistema estatal", "sistema nacional", "modelo nacional", "profesionalización", "profesionalizacion", "capacitación", "capacitacion", "formación", "formacion",
    "prevención del delito", "prevencion del delito", "fiscaliz", "auditor", "verific", "control interno", "transparencia", "rendición de cuentas", "rendicion de cuentas",
    "evaluación del desempeño", "evaluacion del desempeño", "presupuesto de egresos", "reintegrar", "devengad", "adherirse", "sistema nacional de coordinación fiscal", "coordinación fiscal",
    "coordinacion fiscal", "15 de enero", "31 de diciembre",
]
GUARDRAIL_KEYWORDS = ["fasp", "fondo", "aportaciones", "seguridad", "publica", "convenio", "anexo", "tecnico", "coordinacion", "federales", "remanentes", "transferencias"]

VOCABULARIES = {
    "etapas_ciclo": STAGES,
    "dimensiones_ciclo": DIMENSIONS,
    "tipos_competencia": ["Exclusiva", "Concurrente", "Complementaria"],
    "niveles_obligatoriedad": ["Mandatoria", "Facultativa", "Recomendatoria"],
    "tipos_vinculo": ["Formal", "Informal", "Jerárquico", "Operativo", "Consultivo"],
    "niveles_gobierno": ["Federal", "Estatal", "Municipal"],
    "naturaleza_actor": ["Formal", "Informal"],
    "etapas_pipeline": ["etapa_1_documental", "etapa_2_campo_ars", "etapa_3_triangulacion"],
    "estados_documento": ["ingesta", "extraccion", "clasificacion", "checkpoint_pendiente", "aprobado", "rechazado", "publicado"],
}

# (stage, profile, text): the expected gates; a profile may have several texts in a stage
GATES = [
    ("etapa_1_documental", "coordinadora", "Avance general de la Ficha tecnica FASP y coherencia global"),
    ("etapa_1_documental", "analista_senior_juridico", "Avance de la matriz de congruencia y directorio preliminar"),
    ("etapa_1_documental", "coordinacion_evaluacion", "Avance de la narracion de los Informes 1 (8 estados)"),
    ("etapa_1_documental", "coordinadora", "Avance de la Ficha tecnica administrativa (Anexo 11)"),
    ("etapa_1_documental", "analista_senior_juridico", "Avance del Catalogo de unidades administrativas"),
    ("etapa_2_campo_ars", "coordinadora", "Avance del Producto 2 (Hallazgos de Campo + Grupos de Enfoque)"),
    ("etapa_2_campo_ars", "analista_senior_redes", "Avance de edge list, matrices y metricas ARS"),
    ("etapa_2_campo_ars", "analistas_junior_grafos", "Avance de nodos, aristas y clasificacion de relaciones"),
    ("etapa_2_campo_ars", "analista_senior_redes", "Avance de la memoria algoritmica (Anexo 5)"),
    ("etapa_2_campo_ars", "analistas_junior_grafos", "Avance del Diccionario de atributos (Anexo 6)"),
    ("etapa_3_triangulacion", "coordinadora", "Avance de triangulaciones y ajustes de recomendaciones"),
    ("etapa_3_triangulacion", "coordinacion_evaluacion", "Avance del Informe Final y Estrategia de Consolidacion"),
    ("etapa_3_triangulacion", "coordinacion_evaluacion", "Avance de las fichas del Anexo 10"),
    ("etapa_3_triangulacion", "coordinadora", "Avance del Glosario especializado (Anexo 7)"),
    ("etapa_3_triangulacion", "coordinacion_evaluacion", "Avance de la Metodologia de replicabilidad (Anexo 8)"),
]

PRODUCTS = ["P1", "P2", "P3", "IF"]
STATES = ["MEX", "CHI", "MIC", "TAM", "HID", "QRO", "TAB", "ZAC", "NAL"]
FILE_TYPES = ["INFORME", "MAT_ADY", "MAT_INC", "DIC_NODOS", "SCRIPT", "BBDD"]
EXTENSIONS = [".docx", ".pdf", ".csv", ".xlsx", ".py", ".md", ".txt", ".html", ".png", ".json"]
PROGRAM = "FASP_2026"

FILLER = ["cabe destacar que", "es importante mencionar que", "en términos generales", "de conformidad con lo establecido", "en el marco del presente", "a decir de los resultados", "los resultados arrojan que", "se puede observar que", "se evidencia que", "se hace necesario señalar"]
FIRST_PERSON = ["considero", "creo que", "opino que", "pienso que", "me parece", "en mi opinión", "desde mi punto de vista"]
ABSOLUTES = ["todos los", "ningún", "siempre", "nunca", "100%"]
ACRONYMS = ["FASP", "SESNSP", "DGVS", "SEE", "OIC", "ASF", "SHCP", "CONEVAL", "MIR", "POA", "ROP", "FOFISP"]
LONG_SENTENCE = 35

BIBLIO_KEYS = ["Tag", "SourceType", "AuthorType", "Authors", "CorporateAuthor", "Title", "Year", "City", "Publisher", "Institution", "URL", "Notes"]
SOURCE_TYPES = ["Book", "JournalArticle", "Report", "ElectronicSource", ""]
AUTHOR_TYPES = ["person", "corporate", ""]

MONTHS = {
    "enero": 1, "febrero": 2, "marzo": 3, "abril": 4, "mayo": 5, "junio": 6, "julio": 7, "agosto": 8, "septiembre": 9, "setiembre": 9, "octubre": 10, "noviembre": 11, "diciembre": 12,
    "ene": 1, "feb": 2, "mar": 3, "abr": 4, "may": 5, "jun": 6, "jul": 7, "ago": 8, "sep": 9, "set": 9, "oct": 10, "nov": 11, "dic": 12,
}
DOCUMENT_TYPES = [
    ("CRITERIOS GENERALES", "Criterio"), ("LINEAMIENTO", "Lineamiento"), ("CONSTITUCIÓN POLÍTICA", "Constitución"), ("REGLAMENTO", "Reglamento"), ("CÓDIGO", "Código"),
    ("CONVENIO DE COORDINACIÓN", "Convenio"), ("CONVENIO", "Convenio"), ("ACUERDO", "Acuerdo"), ("MANUAL DE ORGANIZACIÓN", "Manual de organización"), ("MANUAL", "Manual"),
    ("LEY GENERAL", "Ley"), ("DECRETO", "Decreto"), ("NORMA OFICIAL MEXICANA", "Norma"),
]
ISSUERS = [
    "SECRETARIADO EJECUTIVO DEL SISTEMA NACIONAL DE SEGURIDAD PÚBLICA", "CONGRESO DE LA UNIÓN", "PRESIDENCIA DE LA REPÚBLICA", "SECRETARÍA DE GOBERNACIÓN", "SECRETARÍA DE SEGURIDAD Y PROTECCIÓN CIUDADANA",
    "CONSEJO NACIONAL DE SEGURIDAD PÚBLICA", "CÁMARA DE DIPUTADOS", "SENADO DE LA REPÚBLICA", "COMISIÓN PERMANENTE", "INSTITUTO NACIONAL", "AUDITORÍA SUPERIOR DE LA FEDERACIÓN",
]

STATE_NAMES = {"MEX": "Estado de México", "CHI": "Chiapas", "MIC": "Michoacán de Ocampo", "TAM": "Tamaulipas", "HID": "Hidalgo", "QRO": "Querétaro", "TAB": "Tabasco", "ZAC": "Zacatecas", "NAL": "Nacional"}
LEVEL_COLOURS = {"Federal": "#1a4480", "Estatal": "#7a3e9d", "Municipal": "#b5651d", "Desconocido": "#888888"}

# (literal in upper case, medium)
MEDIA = [
    ("DIARIO OFICIAL", "Diario Oficial de la Federación"), ("PERIÓDICO OFICIAL", "Periódico Oficial del Estado"), ("PERIODICO OFICIAL", "Periódico Oficial del Estado"),
    ("GACETA", "Gaceta de Gobierno"), ("SITIO INSTITUCIONAL", "Sitio institucional"), ("WWW.GOB.MX", "Sitio institucional"),
]
CAPITAL = [("CIUDAD DE MÉXICO", "Ciudad de México"), ("CIUDAD DE MEXICO", "Ciudad de México")]
NORM_NUMBERS = [r"\bACUERDO\s+\d+[A-Z]*/[A-Z]+/\d{4}\b", r"\bDECRETO\s+(?:POR\s+EL\s+QUE\s+)?(?:SE\s+)?(?:REFORMA|ADICIONA|EXPIDE)\b", r"\bLINEAMIENTOS\s+\d+/\d{4}\b"]
ISSUER_WORDS = ["SECRETARIADO", "CONSEJO", "CONGRESO", "PRESIDENCIA", "COMISIÓN PERMANENTE"]
# titles of browsers and portals, not of documents
PORTAL_TITLES = [r"^DOF\s*[-–]\s*Diario Oficial", r"^Diario Oficial de la Federaci[oó]n$", r"^Gobierno\s+(de|del)\s+M[eé]xico", r"^Sitio\s+web", r"^Home\s*[-–]", r"^Portal\s+"]
LIBRARY_PREFIX = r"^(Redalyc|SCIELO|JSTOR|Springer)\.\s*"
# title heuristics: lines that are never titles, words that titles have, openings of paragraphs, headings, references to other norms
TITLE_SKIP = [
    r"^\s*p[aá]gina\s+\d+", r"^\s*\d+\s*de\s*\d+", r"^\s*(lunes|martes|mi[eé]rcoles|jueves|viernes|s[aá]bado|domingo)\s+", r"^\s*am[eé]rica\s+no\.", r"^\s*col\.\s+los reyes", r"^\s*cp\.\s+\d",
    r"^\s*tel[eé]fono", r"^\s*www\.", r"^\s*con fundamento en", r"^\s*considerando", r"^\s*visto\s+", r"^\s*art[ií]culo\s+\d+",
]
TITLE_WORDS = [
    "CRITERIOS GENERALES", "LINEAMIENTOS GENERALES", "LINEAMIENTOS PARA", "LINEAMIENTOS", "REGLAMENTO", "CONSTITUCIÓN POLÍTICA", "CÓDIGO", "LEY GENERAL", "MANUAL DE", "CONVENIO DE",
    "CONVENIO DE COORDINACIÓN", "ACUERDO POR EL QUE", "DECRETO POR EL QUE", "CRITERIOS PARA", "REGLAS DE", "TÉRMINOS DE REFERENCIA",
]
TITLE_OPENINGS = r"^\s*(con fundamento|visto\s+|considerando\s+|en ejercicio\s+de\s+las)"
TITLE_HEADINGS = r"^\s*(ANEXO\s+\d|ARTI?CULO\s+\d|CAP[IÍ]TULO\s+\d|SECCI[OÓ]N\s+[IVX]+)"
TITLE_GAZETTE = r"^\s*(DOF|DIARIO\s+OFICIAL|Periodico\s+Oficial)\s*[:\.]?\s*\d"
TITLE_REFERENCE = r"^\s*(Reglamento|Ley|Código|Constitución)\s+(de|del|de\s+la)\s+"
TITLE_STOP = r"^(CAP[ÍI]TULO|SECCI[OÓ]N|ART[ÍI]CULO|TRANSITORIO|DECRETA|APRUEBA)\s+"
JURIDICAL = r"\b(?:art[íi]culo|fracci[oó]n|inciso|numeral|apartado|literal|subnumeral)\b"
PAPER_WORDS = r"^\s*(palabras clave|key words)"
PAPER_PARTS = r"^\s*(resumen|abstract|summary|introducción|introduccion)"
PAPER_NOTE = r"\b(doctor|doctorado|investigaci[oó]n|profesor|instituto|universidad|correo|electr[oó]nico)\b"
REFERENCES_WORD = "referencias"

# columns of the registry, and the fields that fill some of them
REGISTRY_COLUMNS = [
    "Código de archivo", "Ámbito de la norma", "Entidad federativa", "Clave EDO", "Tipo de documento", "Título oficial completo", "Abreviatura oficial", "Órgano emisor", "País", "Fecha de publicación",
    "Medio oficial de publicación", "Número de norma", "Disposición específica citada", "Nota de reformas", "URL", "Fecha de consulta", "Observaciones", "Autor/Responsable de la fuente", "Año",
    "Lugar/Jurisdicción", "Editorial/Institución responsable", "Identificador (DOI/ISBN/Expediente)", "Páginas/Artículos consultados", "Formato de cita sugerido", "Estatus de captura",
]
REGISTRY_FIELDS = {
    "codigo_archivo": 0, "ambito": 1, "entidad_federativa": 2, "clave_edo": 3, "tipo_documento": 4, "titulo": 5, "organo_emisor": 7, "fecha_publicacion": 9, "medio_publicacion": 10, "numero_norma": 11,
    "url": 14, "autor": 17, "anio": 18, "lugar": 19, "editorial": 20, "formato_cita_apa": 23,
}
REGISTRY_TITLE = "FASP Registro Normatividad"

# constraints of the tables: columns that are never null, unique keys, allowed values, ranges, (column, table, column) references
TABLES = {
    "documentos": {"not_null": ["id", "nombre_archivo", "tipo_documento", "fecha_ingesta", "estado"], "unique": ["id"]},
    "normas": {"not_null": ["id_norma", "id_documento", "nombre_norma", "nivel"], "unique": ["id_norma"], "allowed": {"nivel": VOCABULARIES["niveles_gobierno"]}, "refers": [("id_documento", "documentos", "id")]},
    "norma_unidades": {
        "not_null": ["id", "id_norma", "articulo", "texto", "etapa_ciclo_fasp", "dimension_ciclo", "tipo_competencia", "nivel_obligatoriedad"], "unique": ["id"],
        "allowed": {"etapa_ciclo_fasp": STAGES, "dimension_ciclo": DIMENSIONS, "tipo_competencia": VOCABULARIES["tipos_competencia"], "nivel_obligatoriedad": VOCABULARIES["niveles_obligatoriedad"]},
        "refers": [("id_norma", "normas", "id_norma")],
    },
    "actores": {"not_null": ["id_actor", "nombre_oficial", "nivel_gobierno", "naturaleza", "funciones_json"], "unique": ["id_actor"], "allowed": {"nivel_gobierno": VOCABULARIES["niveles_gobierno"], "naturaleza": VOCABULARIES["naturaleza_actor"]}, "refers": [("fuente_documento", "documentos", "id")]},
    "actor_etapas": {"not_null": ["id_actor", "etapa_ciclo"], "unique": ["id_actor,etapa_ciclo"], "allowed": {"etapa_ciclo": STAGES}, "refers": [("id_actor", "actores", "id_actor")]},
    "aristas": {
        "not_null": ["id", "origen", "destino", "peso", "tipo_vinculo", "direccionalidad", "frecuencia", "canal", "etapa_ciclo"], "unique": ["id"], "ranges": {"peso": (0, 10)},
        "allowed": {
            "tipo_vinculo": VOCABULARIES["tipos_vinculo"], "direccionalidad": ["unidireccional", "bidireccional"], "frecuencia": ["diaria", "semanal", "mensual", "trimestral", "ocasional"],
            "canal": ["oficial", "informal", "electrónico", "presencial", "mixto"], "etapa_ciclo": STAGES,
        },
        "refers": [("origen", "actores", "id_actor"), ("destino", "actores", "id_actor"), ("evidencia_doc_id", "documentos", "id"), ("fuente_doc_id", "documentos", "id")],
    },
    "metricas_ars": {"not_null": ["id_actor"], "unique": ["id_actor"], "refers": [("id_actor", "actores", "id_actor")]},
    "fichas": {
        "not_null": ["id_ficha", "categoria_tematica", "verbo", "producto_proceso", "area_oportunidad", "justificacion", "efecto_esperado", "prioridad", "created_at"], "unique": ["id_ficha"],
        "allowed": {"categoria_tematica": ["Normativo", "Organizacional", "Capacidades", "Canales de comunicación"], "prioridad": ["Alta", "Media", "Baja"]},
        "ranges": {"viabilidad_claridad": (1, 5), "viabilidad_relevancia": (1, 5), "viabilidad_justificacion": (1, 5), "viabilidad_factibilidad": (1, 5)},
    },
    "checkpoints": {
        "not_null": ["id", "etapa", "perfil", "anexo", "decision", "fecha"], "unique": ["id"],
        "allowed": {"etapa": VOCABULARIES["etapas_pipeline"], "perfil": ["coordinadora", "analista_senior_juridico", "analista_senior_redes", "analistas_junior_grafos", "coordinacion_evaluacion"], "decision": ["aprobado", "rechazado", "pendiente"]},
    },
    "audit_log": {"not_null": ["id", "timestamp", "modulo", "accion"], "unique": ["id"]},
}
#: Validators: the list of an object's rows, fields with allowed values, fields that are lists of such, fields from 1 to 5.
VALIDATORS = {
    "matriz_congruencia": {"rows": "filas", "allowed": {"etapa_ciclo_fasp": STAGES, "dimension_ciclo": DIMENSIONS, "tipo_competencia": VOCABULARIES["tipos_competencia"], "nivel_obligatoriedad": VOCABULARIES["niveles_obligatoriedad"], "nivel": VOCABULARIES["niveles_gobierno"]}},
    "directorio_actores": {"rows": "actores", "allowed": {"nivel_gobierno": VOCABULARIES["niveles_gobierno"], "naturaleza": VOCABULARIES["naturaleza_actor"]}, "lists": {"etapas_ciclo_participa": STAGES}},
    "matriz_adyacencia": {"rows": "matriz", "allowed": {"tipo_vinculo": VOCABULARIES["tipos_vinculo"]}},
    "fichas_hallazgos": {"rows": "fichas", "allowed": {"categoria_tematica": TABLES["fichas"]["allowed"]["categoria_tematica"], "prioridad": ["Alta", "Media", "Baja"]}, "scores": ["viabilidad_claridad", "viabilidad_relevancia", "viabilidad_justificacion", "viabilidad_factibilidad"]},
}
_STRINGS = {"type": "array", "items": "string"}
_STAGES_PLAIN = ["Integracion", "Distribucion", "Administracion", "Supervision", "Seguimiento"]
#: Annexes: required keys, rules of the keys, and for the key that holds rows the same for each row.
ANNEXES = {
    "anexo1": {
        "required": ["id_ficha", "id_evaluacion", "nombre_programa", "fecha_elaboracion", "responsable"],
        "properties": {
            "id_ficha": {"pattern": "^[A-Z]{2,5}-[A-Z0-9-]+$"}, "nombre_programa": {"enum": ["Fondo de Aportaciones para la Seguridad Pública"]}, "anio_fiscal": {"type": "integer", "minimum": 2008, "maximum": 2030}, "rama": {"enum": ["Seguridad Pública"]},
            "marco_normativo_general": _STRINGS, "objetivos_evaluacion": _STRINGS, "alcance": {"enum": ["Federal", "Estatal", "Municipal", "Federal+Estatal", "Federal+Estatal+Municipal"]}, "metodologia": {"enum": ["Análisis normativo+ARS+triangulación"]},
        },
    },
    "anexo2": {"required": ["id_matriz", "filas"], "rows": ("filas", {"required": ["id_unidad", "id_norma", "articulo", "fraccion", "tema"], "properties": {k: {"enum": v} for k, v in VALIDATORS["matriz_congruencia"]["allowed"].items()} | {"duplicidad_detectada": {"type": "boolean"}, "contradiccion_detectada": {"type": "boolean"}}})},
    "anexo3": {"required": ["actores"], "rows": ("actores", {"required": ["id_actor", "nombre_oficial", "nivel_gobierno", "naturaleza", "funciones"], "properties": {"id_actor": {"pattern": "^ACT-[A-Z0-9-]+$"}, "nivel_gobierno": {"enum": VOCABULARIES["niveles_gobierno"]}, "naturaleza": {"enum": VOCABULARIES["naturaleza_actor"]}, "funciones": _STRINGS, "mapeado_a_id_norma": _STRINGS, "alias_conocidos": _STRINGS}})},
    "anexo4": {"required": ["matriz"], "rows": ("matriz", {"required": ["origen", "destino", "peso", "tipo_vinculo"], "properties": {"peso": {"type": "number", "minimum": 0, "maximum": 10}} | {k: {"enum": v} for k, v in TABLES["aristas"]["allowed"].items()}})},
    "anexo5": {"required": ["secciones"], "properties": {"tratamiento_lazos": {"enum": ["dirigidos", "no_dirigidos", "ponderados", "sin_ponderar"]}, "escala_intensidad": {"type": "object"}, "metricas_calculadas": _STRINGS}},
    "anexo6": {"required": ["nodos"], "rows": ("nodos", {"required": ["id_actor", "nombre_oficial"], "properties": {"nivel_gobierno": {"enum": VOCABULARIES["niveles_gobierno"]}, "rol_ciclo_fasp": _STRINGS, "confianza_identificacion": {"type": "number", "minimum": 0, "maximum": 1}}})},
    "anexo10": {
        "required": ["fichas"],
        "rows": ("fichas", {
            "required": ["id_ficha", "verbo", "producto_proceso", "area_oportunidad", "justificacion", "efecto_esperado"],
            "properties": {"id_ficha": {"pattern": "^FCH-[0-9]+$"}, "categoria_tematica": {"enum": TABLES["fichas"]["allowed"]["categoria_tematica"]}, "prioridad": {"enum": ["Alta", "Media", "Baja"]}} | {f"viabilidad_SHCP_{k}": {"type": "integer", "minimum": 1, "maximum": 5} for k in ("claridad", "relevancia", "justificacion", "factibilidad")},
        }),
    },
    "anexo11": {
        "required": ["id_ficha", "entidad_federativa", "procesos_administrativos"],
        "properties": {"id_ficha": {"pattern": "^FASP-2026-(P3|IF)-[A-Z]{3}-[A-Z0-9-]+$"}, "entidad_federativa": {"enum": STATES}, "nombre_estado": {"enum": ["Estado de Mexico", "Chiapas", "Michoacan de Ocampo", "Tamaulipas", "Hidalgo", "Queretaro", "Tabasco", "Zacatecas", "Agregacion Nacional"]}},
        "rows": ("procesos_administrativos", {"required": ["id_proceso", "nombre", "etapa_ciclo_fasp", "responsable"], "properties": {"id_proceso": {"pattern": "^PROC-[A-Z0-9-]+$"}, "etapa_ciclo_fasp": {"enum": _STAGES_PLAIN}, "estado_actual": {"enum": ["operativo", "parcial", "no_operativo"]}}}),
    },
    "anexo12": {
        "required": ["fuentes"],
        "rows": ("fuentes", {
            "required": ["id_fuente", "tipo", "titulo", "fecha_acceso"],
            "properties": {
                "id_fuente": {"pattern": "^FU-[0-9]+$"}, "entidad_federativa": {"enum": [*STATES, "Federal"]},
                "tipo": {"enum": ["norma_federal", "norma_estatal", "norma_municipal", "convenio", "manual", "lineamiento", "informe_institucional", "transcripcion_entrevista", "transcripcion_grupo_enfoque", "articulo_academico", "base_datos_publica", "documento_interno"]},
            },
        }),
    },
}

# (texts of which every group must have one in the article, article number that is enough, outcome), the first that holds counts
INTERPRETATIONS = [
    ([["fasp"], ["administrar", "ejercer"]], None, "el articulo vincula directamente la operacion del FASP al establecer que el Estado administrara y ejercera los recursos del Fondo conforme a los lineamientos federales y la legislacion estatal aplicable"),
    ([["fasp"], ["celebrar", "convenio"]], None, "el articulo es la base juridica para celebrar el Convenio de Coordinacion del FASP entre la Federacion y el Estado, fijando montos, copago y obligaciones especificas"),
    ([["fasp"], ["reportar", "informar", "trimestral"]], None, "el articulo obliga al Estado a reportar trimestralmente al SESNSP el ejercicio de los recursos del FASP, mecanismo clave de control del Fondo"),
    ([["fasp"], ["fiscaliz", "auditoria"]], None, "el articulo establece los mecanismos de fiscalizacion sobre los recursos del FASP transferidos al Estado, previniendo su uso indebido"),
    ([["fasp"]], None, "el articulo regula directamente la operacion del FASP en el Estado"),
    ([["fondo de aportaciones"]], None, "el articulo regula la operacion del Fondo de Aportaciones (Ramo 33), mecanismo constitucional mediante el cual el FASP llega a las entidades federativas"),
    ([["convenio"], ["coordinacion", "coordinación"], ["celebrar"]], None, "este articulo es el fundamento juridico que habilita al Estado para suscribir el Convenio de Coordinacion del FASP con la Federacion, instrumento mediante el cual se transfieren los recursos del Fondo"),
    ([["convenio"], ["coordinacion", "coordinación"]], None, "el articulo regula el Convenio de Coordinacion mediante el cual se formaliza la recepcion de los recursos federales del FASP"),
    ([["anexo"], ["tecnico", "técnico"]], None, "el articulo obliga a formalizar el Anexo Tecnico del FASP que detalla proyectos, metas, montos y plazos de los recursos federales transferidos al Estado"),
    ([["aportaciones federales", "recursos federales"], ["administrar", "ejercer"]], None, "el articulo obliga al Estado a administrar las aportaciones federales (entre ellas el FASP del Ramo 33) conforme a la legislacion estatal y los lineamientos federales"),
    ([["aportaciones federales", "recursos federales"], ["presupuest"]], None, "el articulo obliga a presupuestar las aportaciones federales del Ramo 33 (incluido el FASP) en el Presupuesto de Egresos del Estado para su ejercicio anual"),
    ([["aportaciones federales", "recursos federales"], ["destinar"]], None, "el articulo obliga a destinar las aportaciones federales (incluido el FASP) a los fines del Fondo conforme a los Convenios de Coordinacion suscritos con la Federacion"),
    ([["aportaciones federales", "recursos federales"]], None, "el articulo regula el manejo de las aportaciones federales transferidas al Estado, entre las cuales se incluye el FASP"),
    ([["ramo 33", "ramo general 33"]], None, "el articulo identifica las aportaciones del Ramo General 33, entre las cuales se incluye el FASP como uno de los fondos federales que recibe el Estado"),
    ([["reintegrar", "devengad"]], None, "el articulo obliga al Estado a reintegrar a la Tesoreria de la Federacion las transferencias federales (incluido el FASP) que no fueron devengadas al cierre del ejercicio fiscal"),
    ([["transferencia"]], None, "el articulo regula las transferencias federales al Estado, mecanismo mediante el cual se reciben los recursos del FASP cada ejercicio fiscal"),
    ([["adherirse", "convenio de adhesion", "sistema nacional de coordinacion fiscal"]], None, "el articulo regula la adhesion del Estado al Sistema Nacional de Coordinacion Fiscal, lo que permite la recepcion del FASP como parte del Ramo 33 de las transferencias federales"),
    ([["celebrar acuerdos", "celebrar convenios"]], None, "este articulo constituye el fundamento juridico para que el Gobernador suscriba el Convenio de Coordinacion del FASP con el Poder Ejecutivo Federal, asi como los acuerdos derivados del Anexo Tecnico anual"),
    ([["representación legal", "representacion legal"]], None, "este articulo atribuye al Gobernador (directamente o por conducto de la Secretaria de Gobierno) la representacion legal del Estado, requisito para suscribir el Convenio del FASP y su Anexo Tecnico"),
    ([["refrend"]], None, "el articulo establece el requisito de refrendo del Secretario de Gobierno para la validez de los Convenios del FASP y los acuerdos de coordinacion que suscriba el Gobernador"),
    ([["designar"], ["dependencias"]], None, "el articulo faculta al Gobernador para designar las dependencias del Estado (Secretaria de Seguridad, Planeacion y Finanzas, etc.) que coordinaran la ejecucion de los recursos del FASP"),
    ([["siguientes dependencias", "auxiliarán al titular"]], 19, "el articulo enumera las dependencias centralizadas del Estado que participaran en la coordinacion del FASP, identificando a la Secretaria de Seguridad, Planeacion y Finanzas y otras instancias relevantes para el Fondo"),
    ([["modelo nacional"], ["policía", "policia"]], None, "el articulo obliga al Estado a destinar un porcentaje no menor al 10% del FASP para el impulso al Modelo Nacional de Policia y Justicia Civica, en cumplimiento de los lineamientos federales"),
    ([["profesionalizacion", "profesionalización", "formación", "formacion", "capacitacion", "capacitación"]], None, "el articulo regula la profesionalizacion policial, que es uno de los destinos del FASP conforme a los Programas con Prioridad Nacional vigentes"),
    ([["seguridad"], ["sistema", "estatal"], ["integrar", "coordinar"]], None, "el articulo obliga a integrar y coordinar el Sistema Estatal de Seguridad Publica, instancia que opera los recursos del FASP conforme a las prioridades nacionales en seguridad"),
    ([["seguridad"], ["sistema", "estatal"]], None, "el articulo regula el Sistema Estatal de Seguridad Publica, instancia normativa que articula el ejercicio de los recursos del FASP en el Estado"),
    ([["prevencion del delito", "prevención del delito", "prevencion"]], None, "el articulo regula la prevencion del delito, uno de los destinos del FASP conforme a los Programas con Prioridad Nacional"),
    ([["presupuesto"], ["egresos"]], None, "el articulo obliga a incluir las aportaciones federales (incluido el FASP) en el Presupuesto de Egresos del Estado para su ejercicio durante el ejercicio fiscal"),
    ([["verific", "fiscaliz", "auditor"]], None, "el articulo establece la verificacion y fiscalizacion del ejercicio de los recursos federales transferidos (incluido el FASP) por parte de los organos de control"),
    ([["control"], ["interno", "gobierno"]], None, "el articulo obliga a los organos de control interno a vigilar el ejercicio de los recursos del FASP conforme a la legislacion aplicable"),
    ([["transparencia", "rendición", "rendicion"]], None, "el articulo obliga a transparentar y reportar el ejercicio de los recursos del FASP conforme a los principios de rendicion de cuentas"),
    ([["evaluacion del desempeno", "evaluación del desempeño"]], None, "el articulo regula la evaluacion del desempeno del ejercicio de los recursos del FASP, mecanismo de supervision del Fondo"),
    ([["publicación", "publicacion", "periódico oficial", "periodico oficial"]], None, "el articulo obliga a publicar en el periodico oficial las disposiciones que regulan la operacion de los recursos federales transferidos al Estado, incluidos los del FASP"),
    ([["reglamento"], ["expedir", "emitir"], ["días", "dias", "meses", "naturales"]], None, "el articulo fija un plazo determinado para expedir el reglamento de la ley, lo que permitira operativizar el ejercicio del FASP en el Estado"),
    ([["sistema nacional", "coordinacion nacional"]], None, "el articulo articula la vinculacion del Estado con el Sistema Nacional de Seguridad Publica, instancia que coordina la operacion del FASP con las entidades federativas"),
]
NO_INTERPRETATION = ("el articulo establece atribuciones o procedimientos que el Estado debe observar para la correcta coordinacion del FASP y el ejercicio de los recursos federales transferidos en el proceso de ", "")
