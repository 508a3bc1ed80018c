"""Fixed values the results depend on (code lists, names, thresholds)."""

# Order statuses accepted in Silver. Cancellations are quarantined before this list applies.
ORDER_STATUSES = [
    "approved", "created", "delivered", "invoiced", "processing", "shipped", "unavailable",
]

# Payment instruments accepted in Silver. "not_defined" marks a missing instrument.
PAYMENT_TYPES = ["boleto", "credit_card", "debit_card", "voucher"]

# States of each macro-region, and the label of a state outside the list.
MACRO_REGION_STATES = {
    "Centro-Oeste": ["DF", "GO", "MS", "MT"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Norte": ["AC", "AM", "AP", "PA", "RO", "RR", "TO"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
}
UNKNOWN_MACRO_REGION = "Desconhecido"

# Currency names by ISO 4217 code. Other codes are named by the code itself.
CURRENCY_NAMES = {
    "ARS": "Argentine Peso",
    "AUD": "Australian Dollar",
    "BRL": "Brazilian Real",
    "CAD": "Canadian Dollar",
    "CHF": "Swiss Franc",
    "CLP": "Chilean Peso",
    "CNY": "Chinese Yuan Renminbi",
    "COP": "Colombian Peso",
    "EUR": "Euro",
    "GBP": "British Pound Sterling",
    "JPY": "Japanese Yen",
    "MXN": "Mexican Peso",
    "PEN": "Peruvian Sol",
    "USD": "US Dollar",
}

# Cities whose daily weather is landed (name, state, latitude, longitude).
WEATHER_CITIES = [
    ("belem", "PA", -1.4558, -48.5044),
    ("belo horizonte", "MG", -19.9167, -43.9345),
    ("brasilia", "DF", -15.7942, -47.8825),
    ("campinas", "SP", -22.9056, -47.0608),
    ("campo grande", "MS", -20.4697, -54.6201),
    ("curitiba", "PR", -25.4278, -49.2731),
    ("fortaleza", "CE", -3.7172, -38.5434),
    ("goiania", "GO", -16.6864, -49.2643),
    ("guarulhos", "SP", -23.4543, -46.5333),
    ("joao pessoa", "PB", -7.1195, -34.8450),
    ("maceio", "AL", -9.6658, -35.7350),
    ("manaus", "AM", -3.1190, -60.0217),
    ("natal", "RN", -5.7945, -35.2110),
    ("porto alegre", "RS", -30.0369, -51.2090),
    ("recife", "PE", -8.0539, -34.8811),
    ("rio de janeiro", "RJ", -22.9068, -43.1729),
    ("salvador", "BA", -12.9714, -38.5014),
    ("sao luis", "MA", -2.5297, -44.3028),
    ("sao paulo", "SP", -23.5505, -46.6333),
    ("teresina", "PI", -5.0892, -42.8019),
]

# Weather category by WMO code range (inclusive). Other codes are "other".
WEATHER_CATEGORIES = [
    ("clear", 0, 1),
    ("cloudy", 2, 3),
    ("rainy", 51, 67),
    ("rainy", 80, 82),
    ("stormy", 95, 99),
]

# Thresholds of the measures and of the dashboard rules.
RAINY_DAY_MM = 10
CLEAR_DAY_CODES = [0, 1, 2]
HIGH_VALUE_PRICE = 500
DROP_WARNING_PCT = 10
SEVERITY_RANK = {"INFO": 0, "WARNING": 1, "CRITICAL": 2}
PASS_RATE_GREEN_PCT = 95
PASS_RATE_AMBER_PCT = 90
