"""Fixed values.

Word lists, patterns, constants and column names that must have exactly these
values for results to be right.  Nothing in this module is derived.
"""

# --- missing-value words a CSV scan turns into null ------------------------
NA_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# --- listing columns -------------------------------------------------------
BRAND = "Marca"
MODEL = "Modelo"
VERSION = "Versión"
TITLE = "Título"
TEXT = "Descripción"
ENGINE = "Motor"
KM = "Kilómetros"
PRICE = "Precio"
CURRENCY = "Moneda"
FUEL = "Tipo de combustible"
BODY = "Tipo de carrocería"
GEARBOX = "Transmisión"
SELLER = "Tipo de vendedor"
CAMERA = "Con cámara de retroceso"
COLOUR = "Color"
DOORS = "Puertas"
YEAR = "Año"
TURBO = "Turbo"
POWER = "cv"
TRACTION = "Tracción"
DOWN_PAYMENT = "price_is_anticipo"
ROW_ID = "idx"

# --- attribute patterns ----------------------------------------------------
TURBO_PATTERN = r"(?iU)turbo|\d[\.,]?\d?\s*t|tsi|tfsi"
POWER_PATTERN = r"(?iU)(\d+)\s*(cv|hp)\b"
FOUR_WHEEL_PATTERN = r"(?i)4x4|4wd|awd"
TWO_WHEEL_PATTERN = r"(?i)4x2|2wd|fwd"
ENGINE_DOT_PATTERN = r"(?U)\b(\d\.\d)\b"
ENGINE_COMMA_PATTERN = r"(?U)\b(\d,\d)\b"

# --- tokens removed from a version text ------------------------------------
ENGINE_SIZE_TOKEN = r"(?U)(^|\s)(\d[\.,]\d)\s*[Ll]?(?=\s|$|\W)"
TURBO_SIZE_TOKEN = r"(?U)\b\d[\.,]?\d?\s*[tT]\b"
TURBO_WORD_TOKEN = r"(?iU)\b(TSI|TFSI|TURBO)\b"
GEARBOX_COUNT_TOKEN = r"(?iU)\b\d*\s*(at|mt|dct|cvt)\d*\b"
GEARBOX_WORD_TOKEN = r"(?iU)\b(at|mt|dct|cvt|automática|manual)\b"
POWER_TOKEN = r"(?iU)\b\d+\s*(cv|hp)\b"
TRACTION_TOKENS = [
    r"(?iU)\b4x[24]\b", r"(?iU)\bawd\b", r"(?iU)\b4wd\b", r"(?iU)\b2wd\b", r"(?iU)\bfwd\b",
]
FUEL_WORDS_TOKEN = r"(?U)\b(nafta|gasolina|diesel|gnc|gas|híbrido|eléctrico)\b"
BODY_WORDS_TOKEN = r"(?U)\b(suv|sedan|hatchback|pickup|coupe|convertible)\b"

# --- down-payment wording --------------------------------------------------
DOWN_PAYMENT_STRONG = [
    r"(?iU)(?:precio|valor|importe)\s+(?:publicado|expresado|es)\s+(?:un\s+)?anticipo",
    r"(?iU)precio\s+de\s+anticipo",
    r"(?iU)precio\s+publicado\s+.*anticipo",
]
DOWN_PAYMENT_WORD = "anticipo"
DOWN_PAYMENT_WEAK = ["cuota", "cuotas", "financi", "resto", "tasa", "plan", "mínimo", "minimo"]

# --- damage wording --------------------------------------------------------
DAMAGE_WORDS = [
    "rot", "a reparar", "detalle", "paragolpes", "reparar", "raya", "golpe", "abolladura",
    "daño", "falla", "problema", "averia", "desperfecto", "mal estado", "necesita", "arreglar",
    "bollo", "choc", "cambiar",
]

# --- colours ---------------------------------------------------------------
BASE_COLOURS = [
    "blanco", "negro", "gris", "plateado", "azul", "rojo", "verde", "dorado", "amarillo",
    "naranja", "marron", "violeta", "rosa", "otro",
]
NO_COLOUR = "otro"
NO_COLOUR_GROUP = "Otro"
BASE_COLOUR_CUTOFF = 0.6
COLOUR_GROUP_CUTOFF = 0.8
TOP_COLOURS = 16

# --- double-encoded letters ------------------------------------------------
DOUBLE_ENCODED = {
    "Ã¡": "á", "Ã©": "é", "Ã­": "í", "Ã³": "ó", "Ãº": "ú", "Ã±": "ñ", "Ã ": "à",
    "Ã¨": "è", "Ã¬": "ì", "Ã²": "ò", "Ã¹": "ù", "Ã¼": "ü", "Ã§": "ç", "Ã«": "ë",
}

# --- currency --------------------------------------------------------------
DOLLAR = "US$"
RATE_PIPELINE = 1400.0
RATE_EXPLORATION = 1100.0
TO_DOLLAR = {"US$": 1.0, "$": 0.0011}

# --- parameters of the fitted steps ----------------------------------------
MATCH_THRESHOLD = 0.2
DENSITY_SIMILARITY = 0.7          # cosine distance 0.3
SMOOTHING = 10.0
EMBED_COMPONENTS = 5
EMBED_TERMS = 2000
EMBED_MIN_DF = 2
EMBED_MAX_DF = 0.8
OUTLIER_SHARE = 0.01
ISOLATION_TREES = 100
ISOLATION_SAMPLE = 256
NEIGHBOURS = 5
LINKAGE_DISTANCE = 0.8
NEW_KM = 1000
LABEL_KM = 5000

FILL_COLUMNS = [POWER, ENGINE, TRACTION, TURBO]
ENCODED_COLUMNS = [BRAND, MODEL, VERSION]
SCALED_COLUMNS = [ENGINE, POWER, KM, YEAR]
ONE_HOT_COLUMNS = [FUEL, GEARBOX, CURRENCY, SELLER, "Con camára de retroceso"]
DROPPED_COLUMNS = [BODY, TITLE, COLOUR, TEXT, DOWN_PAYMENT, ROW_ID, DOORS, TRACTION, CAMERA]
FIRST_COLUMNS = [
    ROW_ID, BRAND, MODEL, VERSION, TITLE, ENGINE, TURBO, POWER, COLOUR, DOORS, KM, PRICE, TEXT,
    SELLER,
]

# --- parameter sets of the boosted-tree price model ------------------------
BOOSTED_SETS = {
    "pipeline": {"trees": 600, "depth": 6, "rate": 0.01, "row_share": 1.0, "column_share": 0.6, "gamma": 0.0, "alpha": 0.01, "lam": 1.0},
    "script": {"trees": 400, "depth": 5, "rate": 0.1, "row_share": 1.0, "column_share": 0.6, "gamma": 0.0, "alpha": 0.01, "lam": 1.0},
    "analysis": {"trees": 600, "depth": 6, "rate": 0.1, "row_share": 1.0, "column_share": 0.6, "gamma": 0.0, "alpha": 0.01, "lam": 1.0},
    "baseline": {"trees": 100, "depth": 4, "rate": 0.1, "row_share": 1.0, "column_share": 1.0, "gamma": 0.0, "alpha": 0.0, "lam": 1.0},
}
# --- values that a search over boosted trees draws from --------------------
TREE_SPACE = {
    "trees": [100, 200, 300, 400],
    "depth": [3, 4, 5, 6, 7, 8],
    "rate": [0.01, 0.05, 0.1, 0.2],
    "row_share": [0.6, 0.8, 1.0],
    "column_share": [0.6, 0.8, 1.0],
    "gamma": [0, 0.1, 0.2, 0.5],
    "alpha": [0, 0.01, 0.1],
    "lam": [1, 1.5, 2],
}
TREE_SPACE_NEAR = {
    "rate": [0.05, 0.075, 0.1, 0.125],
    "trees": [250, 300, 350, 400],
    "depth": [5, 6, 7],
    "row_share": [0.8, 0.9, 1.0],
    "column_share": [0.5, 0.6, 0.7],
    "gamma": [0, 0.1, 0.3],
    "alpha": [0, 0.005, 0.01, 0.05],
    "lam": [0.8, 1, 1.2, 1.5],
    "least_weight": [1, 3, 5],
}
EMBED_SWEEP = [0, 5, 10, 15, 20, 25, 30, 35, 40]

# --- filter panel of a stored listing page ---------------------------------
PANEL_CLASS = "ui-search-filter-dl"
PANEL_TITLE_CLASS = "ui-search-filter-dt-title"
GRID_CLASS = "ui-search-search-modal-grid-columns"
GRID_ITEM_CLASS = "ui-search-search-modal-filter"
GRID_NAME_CLASS = "ui-search-search-modal-filter-name"
LIST_ITEM_CLASS = "ui-search-filter-container"
LIST_LINK_CLASS = "ui-search-link"
LIST_NAME_CLASS = "ui-search-filter-name"
LIST_QUANTITY_CLASS = "ui-search-filter-results-qty"
MISSING_TEXT = "N/A"
NO_QUANTITY = "(0)"
