"""Fixed values. They define the results, so they are stated as they are and must not be tuned."""

# --- fixed values: observations -------------------------------------------------------------------
TERRITORIES = ["AS", "GU", "PR", "VI", "MP"]
OUTAGE_FLOOR = 10
DEFAULT_P90 = 50.0
DEFAULT_MEAN = 0.0
OUTAGE_FILES = "eaglei_outages_*.csv"
STORM_FILES = "StormEvents_details-ftp_v1.0_d*.csv"
FIRST_STORM_YEAR = 2015
THRESHOLD_YEARS = [2015, 2016, 2017, 2018]
TRAIN_YEARS = [2015, 2016, 2017, 2018, 2019, 2020]
VALIDATION_YEARS = [2021]
TEST_YEARS = [2022]

# --- fixed values: storm event types by group -----------------------------------------------------
WIND = ["Thunderstorm Wind", "High Wind", "Strong Wind", "Tornado"]
WINTER = ["Winter Storm", "Winter Weather", "Ice Storm", "Heavy Snow", "Blizzard", "Sleet"]
FLOOD = ["Flash Flood", "Flood", "Heavy Rain"]
TROPICAL = ["Hurricane (Typhoon)", "Tropical Storm"]
OTHER = ["Extreme Cold/Wind Chill", "Cold/Wind Chill", "Lightning", "Dense Fog", "Freezing Fog"]
GROUPS = ["wind", "winter", "flood", "tropical", "other"]
SEVERITY_WEIGHTS = {"wind": 3, "tropical": 5, "winter": 2, "flood": 2, "other": 1}
SEVERITY_CAP = 10
OPEN_EVENT_HOURS = 3
EVENT_HOURS_CAP = 72

# --- fixed values: model features, in model order -------------------------------------------------
FEATURES = [
    "wind", "winter", "flood", "tropical", "other", "any_storm", "storm_severity",
    "wind_sum_6h", "wind_sum_12h", "wind_sum_24h",
    "any_storm_sum_6h", "any_storm_sum_12h", "any_storm_sum_24h",
    "hour_sin", "hour_cos", "month_sin", "month_cos", "is_weekend", "quarter",
    "lag_1h_peak", "lag_24h_peak", "lag_168h_peak", "lag_24h_label", "lag_168h_label",
    "county_fragility", "null_count", "county_p90", "county_mean_baseline",
]
STORM_FEATURES = FEATURES[:13]
KEYS_AND_TARGETS = ["fips", "hour", "outage_label", "peak_customers_out", "log_peak_customers", "year", "state"]
SEQUENCE_HOURS = 24

# --- fixed values: what-if scenarios --------------------------------------------------------------
STORM_MULTIPLIERS = {
    "No Active Storm": 1.0, "Thunderstorm": 1.4, "Winter Storm": 1.5, "Flash Flood": 1.3,
    "High Wind Event": 1.6, "Hurricane Cat 1": 2.0, "Hurricane Cat 3": 3.5, "Hurricane Cat 5": 5.5,
}
UNKNOWN_STORM_MULTIPLIER = 2.0
HORIZON_DECAY = {3: 0.55, 6: 0.70, 12: 0.85, 24: 1.0}
PRIORITY_WEIGHTS = (0.5, 0.4, 0.1)
PROBABILITY_CAP = 0.999
TIERS = [("CRITICAL", 0.85), ("HIGH", 0.65), ("MEDIUM", 0.40), ("LOW", None)]
TIER_COLOURS = {"CRITICAL": "#ef4444", "HIGH": "#f59e0b", "MEDIUM": "#3b82f6", "LOW": "#10b981"}

# --- fixed values: state codes --------------------------------------------------------------------
STATE_CODES = {
    "01": "AL", "02": "AK", "04": "AZ", "05": "AR", "06": "CA", "08": "CO", "09": "CT", "10": "DE",
    "12": "FL", "13": "GA", "15": "HI", "16": "ID", "17": "IL", "18": "IN", "19": "IA", "20": "KS",
    "21": "KY", "22": "LA", "23": "ME", "24": "MD", "25": "MA", "26": "MI", "27": "MN", "28": "MS",
    "29": "MO", "30": "MT", "31": "NE", "32": "NV", "33": "NH", "34": "NJ", "35": "NM", "36": "NY",
    "37": "NC", "38": "ND", "39": "OH", "40": "OK", "41": "OR", "42": "PA", "44": "RI", "45": "SC",
    "46": "SD", "47": "TN", "48": "TX", "49": "UT", "50": "VT", "51": "VA", "53": "WA", "54": "WV",
    "55": "WI", "56": "WY", "72": "PR", "78": "VI",
}

# --- fixed values: grid ---------------------------------------------------------------------------
KM_PER_DEGREE = 111
SUBSTATION_LINKS, SUBSTATION_LINK_KM = 3, 25
FACILITY_LINKS, FACILITY_LINK_KM = 2, 20
LINE_END_KM, LINE_PARTNER_KM = 5, 30
DEFAULT_VOLTAGE = "115"
TRANSMISSION_VOLTAGES = ["138", "230", "345"]
FACILITY_TYPES = {
    # type: (priority, weight, most hops)
    "hospital": ("CRITICAL", 10, 2),
    "fire_station": ("HIGH", 7, 3),
    "school": ("MEDIUM", 4, 3),
}
RISK_COUNTIES = ["36059", "36103"]
DEFAULT_MEAN_RISK, DEFAULT_MAX_RISK = 0.45, 0.75
EAST_OF, CENTRE_OF = -73.4, -73.6
EAST_FACTOR, WEST_FACTOR, BASE_RISK_CAP = 0.85, 1.15, 0.99
AT_RISK_ABOVE = 0.40
EDGE_OF_STORM_KM, EDGE_FADE_KM = 30, 60
MOST_HOPS = 3
# centre latitude, centre longitude, radius in km
STORM_CIRCLES = {
    "sandy_2012": (40.4, -73.9, 220), "isaias_2020": (40.7, -73.5, 120), "henri_2021": (40.9, -72.8, 100),
}
EDGE_COLOURS = {"at_risk": "#ef4444", "normal": "#1d4ed8"}
SUBSTATION_STYLES = {  # class: (colour, radius)
    "in_zone": ("#ef4444", 12), "elevated": ("#f59e0b", 9), "normal": ("#3b82f6", 6),
}
UNINFORMATIVE_TRAUMA = ["NOT AVAILABLE", "N/A", ""]
