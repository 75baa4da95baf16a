"""Word lists, extensions, thresholds and buckets that results depend on."""

from __future__ import annotations

from dataclasses import dataclass

# Words and letter pairs that hint at a language.
GERMAN_WORDS = "und der die das ein eine ist nicht mit fuer aus dem den des bei oder wir sie dass zum zur ueber".split()
GERMAN_PAIRS = ("ue", "oe", "ae", "ss")
ENGLISH_WORDS = "the and for with from this that your you please dear hello thank invoice date page tax".split()
GERMAN_MONTHS = "januar februar maerz april mai juni juli august september oktober november dezember".split()
ENGLISH_MONTHS = "january february march april may june july august september october november december".split()

# Dates and amounts that hint at a locale.
GERMAN_DATE, GERMAN_AMOUNT = r"\b\d{1,2}\.\d{1,2}\.\d{2,4}\b", r"\b\d{1,3}(?:\.\d{3})*,\d{2}\b"
ENGLISH_DATE, ENGLISH_AMOUNT = r"\b\d{1,2}/\d{1,2}/\d{2,4}\b", r"\b\d{1,3}(?:,\d{3})*\.\d{2}\b"

# File extensions by kind, and media types by extension.
DOCX = (".docx",)
TEXT = (".txt", ".log", ".md", ".csv", ".tsv", ".json", ".yaml", ".yml", ".ini", ".cfg", ".conf")
IMAGE = (".png", ".jpg", ".jpeg", ".tiff", ".tif", ".bmp", ".gif", ".webp")
MEDIA = {
    ".pdf": "application/pdf", ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document", ".txt": "text/plain", ".log": "text/plain", ".md": "text/markdown",
    ".csv": "text/csv", ".tsv": "text/tab-separated-values", ".json": "application/json", ".html": "text/html", ".htm": "text/html", ".xml": "text/xml", ".png": "image/png",
    ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".tiff": "image/tiff", ".tif": "image/tiff", ".bmp": "image/bmp", ".gif": "image/gif", ".webp": "image/webp", ".conf": "text/plain",
}

# Bucket bounds of the duration, size and confidence histograms.
BUCKETS = {
    "validation_ms": (1, 2, 5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000),
    "phase_ms": (1, 2, 5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000, 10000),
    "bytes": (1e3, 1e4, 1e5, 5e5, 1e6, 5e6, 1e7, 5e7, 1e8),
    "ocr_ms": (10, 20, 50, 100, 200, 500, 1000, 2000, 5000, 10000),
    "confidence": (10, 20, 30, 40, 50, 60, 70, 80, 90, 100),
    "io_ms": (5, 10, 20, 50, 100, 200, 500, 1000, 2000),
    "api_ms": (5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000),
    "step_ms": (1, 2, 5, 10, 20, 50, 100, 200, 500, 1000),
}

# What is hidden in log records.
SECRET_KEYS = ("password", "token", "api_key", "authorization", "cookie", "secret", "access_key", "refresh_token")
HASHED_KEYS = ("file_id", "user_id")
OPEN_KEYS = ("run_id", "phase", "flow", "stage", "hostname", "pid")
SECRET_PATTERNS = (
    r"(?i)bearer\s+[a-z0-9\-\._~\+\/=]+", r"(?i)apikey[=:]\s*[a-z0-9\-\._~\+\/=]+", r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+", r"\+?[0-9][0-9\-\s]{6,}[0-9]",
)
REDACTED = "[REDACTED]"


@dataclass(frozen=True)
class Profile:
    """Thresholds of a deployment. The defaults are those of production."""

    low_conf: float = 70.0
    low_text_words: int = 10
    table_min_conf: float = 0.60
    suspicious_chars: int = 200
    review_ratio: float = 0.15
    left_column: float = 0.45
    right_column: float = 0.55
    tables_mode: str = "detect"
    ocr_min_conf: float = 80.0
    blocks: int = 3
    overlay: bool = False
    overlay_area: float = 0.35
    overlay_images: int = 1
    overlay_any: bool = False
    table_min_words: int = 12
    table_min_area: float = 9000.0
    table_max_cells: int = 600


PROFILES = {
    "prod": Profile(),
    "dev": Profile(60.0, 8, 0.5, 150, 0.25, 0.4, 0.6, "extract"),
    "staging": Profile(68.0, 10, 0.55, 180, 0.15, 0.45, 0.55, "detect"),
}
