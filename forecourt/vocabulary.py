"""Domain vocabulary. Every list here is the default of an operator parameter."""

# --- Fixed values -----------------------------------------------------------
AMENITIES = (
    "Sunroof",
    "Leather seats",
    "Navigation system",
    "Bluetooth",
    "Rear camera",
    "Adaptive cruise control",
)

CONDITION_SCORES = {
    "No damage": 0,
    "Minor scratches": 1,
    "Repainted bumper": 2,
    "Dented door": 3,
    "Engine repaired": 4,
    "Accident history": 5,
    "Unknown": 3,
}
DEFAULT_CONDITION_SCORE = 3
UNKNOWN_CONDITION = "Unknown"
ORDERED_CONDITIONS = tuple(c for c in CONDITION_SCORES if c != UNKNOWN_CONDITION)

LUXURY_MAKES = (
    "ferrari",
    "lamborghini",
    "rolls-royce",
    "bentley",
    "maserati",
    "aston-martin",
    "mclaren",
    "maybach",
    "bugatti",
    "porsche",
)
ECONOMY_MAKES = (
    "hyundai",
    "kia",
    "nissan",
    "toyota",
    "honda",
    "mazda",
    "mitsubishi",
    "suzuki",
)

REFERENCE_YEAR = 2025

CONDITION_PATTERN = r"Condition:\s*(.+?)\."
AMENITIES_PATTERN = r"with (.+?)\.\s*Condition:"

LUXURY_SEGMENT = "Luxury"
MASS_SEGMENT = "Mass Market"

# (upper bound of the difference in percent, rating); the last rating is open-ended.
DEAL_RATINGS = (
    (-15.0, "Excellent Deal"),
    (-5.0, "Good Deal"),
    (5.0, "Fair Price"),
    (15.0, "Slightly Overpriced"),
)
DEAL_RATING_ABOVE = "Overpriced"

LUXURY_MIN_CYLINDERS = 6
ECONOMY_MAX_CYLINDERS = 10

# pandas' documented default spellings of a missing value in a CSV field.
CSV_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

SEGMENT_FEATURES = ("price", "mileage", "car_age", "cylinders", "is_luxury")
# --- End of fixed values ----------------------------------------------------


def flag_name(amenity: str) -> str:
    """Column holding the 0/1 indicator of an amenity."""
    return "has_" + amenity.lower().replace(" ", "_")


AMENITY_FLAGS = tuple(flag_name(a) for a in AMENITIES)

NUMERIC_FEATURES = (
    "year", "mileage", "cylinders", "car_age", "mileage_per_year", "log_mileage",
    "condition_score", "feature_count", "is_luxury", *AMENITY_FLAGS,
)
CATEGORICAL_FEATURES = (
    "make", "body_type", "transmission", "fuel_type", "color", "location",
)


def feature_columns(task: str = "regression") -> tuple[list[str], list[str]]:
    """Numeric and categorical model inputs; a classifier never sees its target."""
    if task not in ("regression", "classification"):
        raise ValueError(f"unknown task {task!r}")
    categorical = [
        c for c in CATEGORICAL_FEATURES
        if task == "regression" or c != "body_type"
    ]
    return list(NUMERIC_FEATURES), categorical
