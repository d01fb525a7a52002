"""Fixed values.

Everything here is data that must equal the agreed value for results to be right:
word lists, name maps, rates, sizes and bounds. No logic lives in this module.
"""

# Units of a currency per one US dollar.
DEFAULT_RATES = {"USD": 1.0, "EUR": 0.93, "AMD": 405.0, "RUB": 91.5}

# How a currency is recognised in a price text, first hit wins.
CURRENCY_MARKS = (
    ("AMD", ("֏", "AMD")),
    ("EUR", ("€", "EUR")),
    ("RUB", ("₽", "RUB")),
)
DEFAULT_CURRENCY = "USD"

# What an en-US currency format prints before the amount.
CURRENCY_PREFIX = {"USD": "$", "EUR": "€", "AMD": "AMD\u00a0", "RUB": "RUB\u00a0"}

# Fuel words in the order they are looked for.
FUELS = ("Gasoline", "Diesel", "Hybrid", "Electric", "LPG", "CNG")

# Text markers for "nothing there".
MISSING_TEXT = "N/A"
UNKNOWN_MAKE = "Other"
UNKNOWN_CURRENCY = "?"
UNKNOWN_CATEGORY = "Unknown"
UNKNOWN_NUMBER = -1.0

MILE_IN_KM = 1.60934
PAGE_SIZE = 24
REFERENCE_YEAR = 2025
PRICE_FLOOR = 2000
PRICE_CEILING = 80000

# Crawl settings. Price ranges overlap on their shared bound.
PRICE_RANGES = ((1, 20000), (20000, 50000000))
PAGES_PER_RANGE = 200
CATEGORY_PAGES = 250
CARS_PER_SEARCH_PAGE = 50
SEARCH_YEARS = (1911, 2027)
SEARCH_MILEAGE = (0, 1000000)

# Page titles that mean an anti-robot page came back.
CHALLENGE_TITLES = ("Just a moment", "Security")

# Class attributes of the markup.
CARD_CONTAINER = "gl"
OFFER_CARD = "card"
OFFER_LINK = "click-for-gtag"
DETAIL_TABLE = "pad-top-6 ad-det"

# Cells a tab-separated reader takes as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Attribute names as the site prints them -> feature names.
ATTRIBUTE_FEATURES = {
    "Անվահեծերը": "Wheel_Size",
    "Գույնը": "Color",
    "Դռների քանակը": "Door_Count",
    "Թափքը": "Body_Type",
    "Հեռահարությունը": "Range_Km",
    "Ձիաուժը": "Horsepower",
    "Ղեկը": "Steering",
    "Մարտկոցի տարողունակությունը կվտ": "Battery_Capacity",
    "Մխոցների քանակը": "Cylinders",
    "Մոդիֆիկացիան": "Trim",
    "Շարժիչը": "Fuel_Type",
    "Շարժիչի ծավալը": "Engine_Volume",
    "Սրահի գույնը": "Interior_Color",
    "Վազքը": "Mileage",
    "Վիճակը": "Condition",
    "Փոխանցման տուփը": "Transmission",
    "Քարշակը": "Drive_Type",
    "էլ․ շարժիչների քանակը": "Electric_Motor_Count",
}
CAR_FEATURES = {
    "id": "id",
    "brand": "Make",
    "model": "Model",
    "price": "Price",
    "taxed": "Taxed",
    "year": "Year",
}

# Feature groups and the column order a fitted model expects.
CATEGORICALS = (
    "Make", "Model", "Taxed", "Color", "Body_Type", "Steering", "Trim", "Fuel_Type",
    "Interior_Color", "Condition", "Transmission", "Drive_Type",
)
CLEANED_NUMERICS = (
    "Horsepower", "Range_Km", "Mileage", "Battery_Capacity", "Engine_Volume",
    "Wheel_Size", "Door_Count", "Cylinders",
)
IMPUTED_NUMERICS = (
    "Horsepower", "Range_Km", "Mileage", "Battery_Capacity", "Engine_Volume",
    "Wheel_Size", "Car_Age", "Door_Count", "Cylinders",
)
FEATURE_ORDER = (
    "Make", "Model", "Taxed", "Year", "Wheel_Size", "Color", "Door_Count", "Body_Type",
    "Range_Km", "Horsepower", "Steering", "Battery_Capacity", "Cylinders", "Trim",
    "Fuel_Type", "Engine_Volume", "Interior_Color", "Mileage", "Condition",
    "Transmission", "Drive_Type", "Electric_Motor_Count", "Car_Age",
)
OPTION_FIELDS = (
    "Make", "Condition", "Fuel_Type", "Transmission", "Drive_Type", "Body_Type",
    "Color", "Interior_Color",
)

# Bounds and choices of a score request.
REQUEST_BOUNDS = {
    "year": (1990, 2026),
    "mileage": (0, None),
    "engine": (0.0, 8.0),
    "hp": (50, 1000),
    "battery": (0, 150),
    "range": (0, 1000),
}
REQUEST_CYLINDERS = ("4", "6", "8", "12", "Unknown")
REQUEST_STEERING = ("Left", "Right")
DEFAULT_DOORS = 4.0
DEFAULT_MOTORS = 0.0

# Split and boosting settings.
TEST_SHARE = 0.2
SPLIT_SEED = 42
TREE_DEPTH = 8
LEARNING_RATE = 0.08
