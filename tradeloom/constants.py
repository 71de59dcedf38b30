"""Literals that must be exactly these for the results to be right."""

# Status and category literals of the shop data.
APPROVED = "Approved"
CANCELED = "Canceled"
MASS_CUSTOMER = "Mass Customer"
UNKNOWN_ID = 0
UNKNOWN_NAME = "Unknown"

# Text that a CSV cell may hold instead of a missing value (the default list of pandas.read_csv).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Spellings of the raw customer file. A value missing from a map takes the default beside it.
GENDER_CODES = {"Male": "M", "Female": "F", "F": "F", "U": "U"}
GENDER_DEFAULT = "U"
YES_NO_LETTER = {"Y": True, "N": False}
YES_NO_WORD = {"Yes": True, "No": False}
STATE_ALIASES = {"VIC": "Victoria", "New South Wales": "NSW"}

# Texts shown for documents without a title or a year.
NO_TITLE = "Без названия"
NO_YEAR = "Неизвестно"
NO_YEAR_LABEL = "N/A"
