"""Domain constants.

FIXED VALUES — these must equal the behaviour being reproduced; they are
stated plainly, in natural order, and are not derived from anything.
"""

# ---------------------------------------------------------------- FIXED VALUES
RAW_FOOD_COLUMNS = ["label", "weight", "calories", "protein", "carbohydrates",
                    "fats", "fiber", "sugars", "sodium"]
RAW_TEXT_COLUMNS = ["label", "weight"]
RAW_NUMERIC_COLUMNS = ["calories", "protein", "carbohydrates", "fats", "fiber",
                       "sugars", "sodium"]

# bronze name -> silver (business) name
SILVER_NAMES = {
    "label": "food_name",
    "weight": "serving_description",
    "fats": "fat_g",
    "sugars": "sugar_g",
    "protein": "protein_g",
    "fiber": "fiber_g",
    "carbohydrates": "carbohydrates_g",
    "calories": "calories_kcal",
    "sodium": "sodium_mg",
}

FIRST_NUMBER_PATTERN = r"([0-9]+(\.[0-9]+)?)"

BAND_VALUES = ["low", "medium", "high"]
# band column -> (source column, low edge, high edge); < low: low, < high: medium, else high
BANDS = {
    "calorie_band": ("calories_kcal", 150, 300),
    "protein_band": ("protein_g", 5, 15),
    "carb_band": ("carbohydrates_g", 10, 25),
    "fat_band": ("fat_g", 5, 15),
}
# flags: protein >= 10 and kcal <= 250; fiber >= 5; sugar <= 8
HIGH_PROTEIN_MIN = 10
LOW_CALORIE_MAX = 250
HIGH_FIBER_MIN = 5
LOW_SUGAR_MAX = 8

GOALS = ["weight_loss", "weight_gain", "maintenance"]

# score weights per goal
LOSS_WEIGHTS = {"protein_g": 2.5, "fiber_g": 2.0, "calories_kcal": -0.015,
                "sugar_g": -0.8, "fat_g": -0.2}
GAIN_WEIGHTS = {"calories_kcal": 0.02, "protein_g": 2.0, "carbohydrates_g": 0.8,
                "fat_g": 0.5}
MAINTENANCE_WEIGHTS = {"protein_g": 2.0, "fiber_g": 1.5, "sugar_g": -0.7}
MAINTENANCE_KCAL_CENTER = 400
MAINTENANCE_KCAL_PENALTY = 0.01
SCORE_DECIMALS = 2
TOP_K = 10

REASONS = {
    "weight_loss": "Higher protein/fiber with relatively lower calories and sugar",
    "weight_gain": "Higher calories and protein for weight gain support",
    "maintenance": "Balanced nutrition profile for maintenance",
}

GOAL_LABELS = {
    "weight_loss": "Weight Loss",
    "weight_gain": "Weight Gain",
    "maintenance": "Maintenance",
}

VALID_GENDERS = ["male", "female", "other", "prefer_not_to_say"]
EVENT_TYPES = ["create", "update", "delete"]
DEFAULT_EVENT_TYPE = "create"

# payload rules: name 1-100 chars; height in (0, 300]; weights in (0, 800];
# birth date before today and not before 1900
NAME_MAX_LEN = 100
HEIGHT_MAX = 300
WEIGHT_MAX = 800
BIRTH_YEAR_MIN = 1900

FIELD_MESSAGES = {
    "height_cm": "height_cm must be greater than 0 and at most 300 cm",
    "current_weight_lb": "current_weight_lb must be greater than 0 and at most 800 lb",
    "target_weight_lb": "target_weight_lb must be greater than 0 and at most 800 lb",
    "user_name": "user_name is required and must be 1–100 characters",
    "gender": "gender must be one of: male, female, other, prefer_not_to_say",
    "birth_date": "birth_date must be a valid date in YYYY-MM-DD format",
}

PROGRESS_STATES = ["initial", "improving", "not_improving", "unchanged"]

USER_ID_PATTERN = "^U[0-9]+$"
USER_ID_PREFIX, USER_ID_DIGITS = "U", 3

# warehouse numeric type
WAREHOUSE_DECIMAL = (10, 2)

DIM_FOOD_COLUMNS = [
    "food_name", "serving_description", "serving_size_value",
    "calories_kcal", "protein_g", "carbohydrates_g", "fat_g",
    "fiber_g", "sugar_g", "sodium_mg",
    "calorie_band", "protein_band", "carb_band", "fat_band",
    "is_high_protein_low_calorie", "is_high_fiber", "is_low_sugar",
]
FACT_REC_COLUMNS = ["user_id", "food_name", "goal_type", "recommendation_score",
                    "recommendation_rank", "recommendation_reason"]
DIM_USER_BASE_COLUMNS = ["user_id", "height_cm", "current_weight_lb",
                         "target_weight_lb", "goal_type"]
DIM_USER_EXTRA_COLUMNS = ["user_name", "gender", "birth_date", "age"]
# ------------------------------------------------------------ end FIXED VALUES

NUTRIENT_COLUMNS = ["calories_kcal", "protein_g", "carbohydrates_g", "fat_g",
                    "fiber_g", "sugar_g", "sodium_mg"]
