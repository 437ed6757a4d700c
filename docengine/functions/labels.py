"""Labels, markers, patterns, regions and thresholds of the record layout."""

NAME_LABELS = ["name", "பெயர்", "பெயர்‌"]
RELATION_LABELS = {
    "father": ["father", "தந்தையின்", "தந்தை", "தந்தையின்‌", "தந்தையின்‌ பெயர்", "தந்தை பெயர்‌", "தந்தை பெயர்", "தந்தையின் பெயர்", "தந்தையின் பெயர்"],
    "mother": ["mother", "தாயின்", "தாய்", "தாயின்‌", "தாயின்‌ பெயர்", "தாய் பெயர்‌", "தாய் பெயர்", "தாயின் பெயர்", "தாயின் பெயர்"],
    "husband": ["husband", "கணவர்", "கணவர்‌", "கணவர்‌ பெயர்", "கணவர்‌ பெயர்‌", "கணவர் பெயர்", "கணவர் பெயர்", "கணவர் பெயர்"],
}
PHOTO_MARKERS = ["photo", "phot", "available", "புகைப்பட", "படம்"]
STOP_LABELS = [
    "name", "father", "mother", "husband", "house", "number", "age", "gender",
    "பெயர்", "தந்தை", "தந்தையின்", "தாய்", "தாயின்", "கணவர்", "வீட்டு", "எண்", "வயது", "பாலினம்",
    "photo", "available", "புகைப்பட", "படம்",
]
HOUSE_LABELS = ["house no", "house number", "house", "வீட்டு எண்", "வீட்டு எண்‌", "வீடு", "ட்டு எண்", "வீட்டுஎண்"]
AGE_LABELS = ["age", "வயது", "வயது‌"]
GENDER_LABELS = ["gender", "பாலினம்", "பாலினம்‌"]
LABEL_SEPARATORS = [":", "-", "—", "|", "=", "№"]
HOUSE_BAD_SUBSTRINGS = ["GEN", "GENDER", "MALE", "FEMALE", "AVAILABLE", "AGE", "SEX", "GM", "வயது", "பாலினம்", "ஆண்", "பெண்", "PHOTO", "PHOT"]

# Label patterns of the line extractors.
NAME_LINE = r"^(?:பெயர்|name(?:[^\p{L}\p{N}_]|$))"
NAME_PATTERN = "பெயர்|name"
RELATION_WORDS = "தந்தை|தாய்|கணவர்|father|mother|husband"
RELATION_PATTERNS = {
    "father": r"தந்தையின்\s*பெயர்|தந்தை\s*பெயர்|father'?s?\s*name|father",
    "mother": r"தாயின்\s*பெயர்|தாய்\s*பெயர்|mother'?s?\s*name|mother",
    "husband": r"கணவர்\s*பெயர்|கணவர்|husband'?s?\s*name|husband",
}
HOUSE_PATTERN = r"வீட்டு\s*எண்|வீட்டுஎண்|ட்டு\s*எண்|house\s*(?:no|number)?"
AGE_PATTERN = "வயது|age"
GENDER_PATTERN = "பாலினம்|gender"
# Of these, a line that a pattern finds holds one at least, whatever its case.
LINE_MARKS = {
    NAME_PATTERN: ["பெயர்", "name"], HOUSE_PATTERN: ["ட்டு", "house"], AGE_PATTERN: ["வயது", "age"], GENDER_PATTERN: ["பாலினம்", "gender"],
    RELATION_PATTERNS["father"]: ["தந்தை", "father"], RELATION_PATTERNS["mother"]: ["தாய", "mother"], RELATION_PATTERNS["husband"]: ["கணவர்", "husband"],
}
VALUE_CUT = "photo|is|available|புகைப்பட|படம்"
GENDER_VALUES = [
    ("ஆண்", "Male"), ("ஆண", "Male"), ("male", "Male"), ("m", "Male"), ("பெண்", "Female"), ("பெண", "Female"), ("female", "Female"), ("f", "Female"),
    ("திருநங்கை", "Other"), ("other", "Other"), ("o", "Other"),
]

# Regions of a crop: x1, y1, x2, y2 relative to its size.
EPIC_ROI = (0.65, 0.05, 0.98, 0.20)
SERIAL_ROIS = [(0.15, 0.06, 0.329, 0.2), (0.12, 0.04, 0.35, 0.22), (0.15, 0.08, 0.32, 0.18), (0.10, 0.02, 0.40, 0.25)]
HOUSE_ROI = (0.02, 0.42, 0.40, 0.54)

# Box detection and crop classification.
CANVAS = (1187, 1679)
BOX_AREA = (0.006, 0.25)
BOX_ASPECT = (0.55, 2.8)
PAD = 3
INK_FRAC = (0.008, 0.28)
MAX_LINE_RATIO = 0.60
MIN_SMALL_COMPONENTS = 35
MAX_LARGEST_CC = 0.22
MIN_EDGE_FRAC = 0.02
POST_MIN_EDGE_FRAC = 0.02
SKIP_SMALL_COMPONENTS = 14
SKIP_LINE_RATIO = 0.70
SKIP_LARGEST_CC = 0.35
SKIP_EDGE_FRAC = 0.015
DEDUPE_TOLERANCE = 6
CONTAIN_MARGIN = 6
CONTAIN_AREA_RATIO = 0.70
INK_MIN = 0.006
TABLE_MIN = 0.002
LOOKBACK = 6

# File kinds of the listings.
PAGE_EXTENSIONS = ["png", "jpg", "jpeg", "webp", "tif", "tiff", "bmp"]
CROP_EXTENSIONS = ["png", "jpg", "jpeg", "webp", "tiff", "bmp"]

# Regions of the fixed-grid layout.
GRID_ROIS = {
    "serial": (0.05, 0.05, 0.35, 0.18), "epic": (0.55, 0.05, 0.98, 0.18), "name": (0.05, 0.20, 0.98, 0.38), "father_name": (0.05, 0.38, 0.98, 0.56),
    "house_no": (0.05, 0.56, 0.98, 0.72), "age": (0.05, 0.72, 0.55, 0.92), "gender": (0.55, 0.72, 0.98, 0.92),
}

# Default endpoint and model by the provider's name.
BASE_URLS = {"": ("https://api.openai.com/v1/", "gpt-4o-mini"), "gemini": ("https://generativelanguage.googleapis.com/v1beta/openai/", "gemini-2.5-flash")}

# Texts that stand for what was not read.
NO_TEXT = "[No text detected]"
READ_ERROR = "[Error processing image: "
NO_JSON = "Could not parse JSON from model response"
