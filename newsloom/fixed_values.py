"""Word lists, patterns, limits and formats that results depend on."""

# ---- Fixed values: feed -------------------------------------------------
FEED_ZONE = "America/Boa_Vista"
SLOT_MINUTES = 15
PACKAGE_SUFFIX = ".gkg.csv.zip"

# Position in a package line (from 0) of each field we keep; themes and
# locations move one position to the left in narrow packages.
FIELD_POSITIONS = {
    "date": (1,),
    "source": (3,),
    "url": (4,),
    "themes": (8, 7),
    "locations": (10, 9),
    "tone": (15,),
    "translation": (25,),
}

# Cell texts that read as null (the list in the public pandas documentation).
NULL_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# ---- Fixed values: signs of a Portuguese page ---------------------------
PT_HOST_SUFFIXES = [".br", ".pt"]

PT_HOSTS = [
    "globo.com", "g1.globo.com", "valor.globo.com", "ge.globo.com",
    "oglobo.globo.com",
    "metropoles.com", "terra.com.br", "uol.com.br", "band.uol.com.br",
    "folha.uol.com.br", "estadao.com.br", "gazetadopovo.com.br",
    "correiobraziliense.com.br", "diariodepernambuco.com.br",
    "gauchazh.clicrbs.com.br", "veja.abril.com.br",
    "gauchazh.com.br", "abril.com.br",
]

PT_SECTIONS = [
    "bbc.com/portuguese",
    "dw.com/pt-br",
    "nytimes.com/pt",
    "france24.com/pt",
    "elpais.com/brasil",
    "elpais.com/america/brasil",
    "theguardian.com/world/portugal",
    "euronews.com/next/pt",
    "euronews.com/pt",
    "cnn.com/brasil",
    "rt.com/portuguese",
    "rfi.fr/pt",
    "afp.com/pt",
]

LANGUAGE_QUERY_KEYS = ["lang", "locale", "hl"]
PT_QUERY_VALUE = r"(?U)\bpt(?:-br)?\b"
PT_CODE = "POR"

SOURCE_LANGUAGE = r"(?iU)\b(?:srclc|srclang|src_lc)[:=]\s*([a-z]{3})\b"
BRAZIL_PLACE = r"(?iU)brazil|\bBRA\b"

# ---- Fixed values: articles ---------------------------------------------
ARTICLE_LIMIT = 200
ARTICLE_MIN_CHARS = 200

# ---- Fixed values: videos -----------------------------------------------
CHANNEL_HANDLE = r"(?U)youtube\.com/@([\w\d_-]+)"
UNKNOWN_CHANNEL = "canal_desconhecido"
WATCH_PREFIX = "https://www.youtube.com/watch?v="
VIDEO_ID_CHARS = 11
TITLE_FORBIDDEN = r'[<>:"/\\|?*]'
TITLE_CHARS = 100
TRANSCRIPT_LANGUAGES = ["pt", "pt-BR"]

# ---- Fixed values: transcript cleaning ----------------------------------
STAGE_MARKS = ["aplausos", "música", "risos", "music", "applause", "laughs", "inaudível"]

# ---- Fixed values: style book -------------------------------------------
BLOCK_CHARS = 1500
LIST_ITEMS = 25
LIST_ITEMS_FLOOR = 15
PARSE_SAMPLE_CHARS = 1000
FORMAT_SAMPLE_CHARS = 800
STYLE_LANGUAGE = "pt-BR"
STYLE_VERSION = "2.0-blocos"
STYLE_SOURCE = "fusão_de_blocos"
PHRASES_INSERTED = 2
OUTLINE = "Introdução indignada sobre: %s\\nResumo do conteúdo\\nOpinião forte com final ácido"
