"""Public codes, bounds, labels and constants results depend on."""

# State digit -> abbreviation.
STATES = {
    "1": "NSW", "2": "VIC", "3": "QLD", "4": "SA", "5": "WA",
    "6": "TAS", "7": "NT", "8": "ACT", "9": "OT",
}

# Digits of a code at each statistical level.
CODE_DIGITS = {"SA1": 11, "SA2": 9, "SA3": 5, "SA4": 3, "STATE": 1}

# Fixed values: (min_lon, max_lon, min_lat, max_lat).
BOUNDS = {
    "mainland": (112.5, 154.0, -39.5, -10.0),
    "all_territories": (96.0, 169.0, -55.0, -9.0),
    "continental": (110.0, 155.0, -45.0, -9.0),
}
STATE_BOUNDS = {
    "NSW": (140.999, 153.639, -37.505, -28.157),
    "VIC": (140.961, 149.976, -39.200, -33.980),
    "QLD": (137.994, 153.552, -29.178, -9.142),
    "SA": (129.002, 141.003, -38.062, -25.996),
    "WA": (112.921, 129.002, -35.134, -13.689),
    "TAS": (143.816, 148.477, -43.648, -39.573),
    "NT": (129.002, 138.001, -26.000, -10.962),
    "ACT": (148.760, 149.399, -35.921, -35.124),
}

# Inclusive postcode ranges.
POSTCODES = {
    "NSW": [(1000, 1999), (2000, 2599), (2619, 2899), (2921, 2999)],
    "ACT": [(200, 299), (2600, 2618), (2900, 2920)],
    "VIC": [(3000, 3999), (8000, 8999)],
    "QLD": [(4000, 4999), (9000, 9999)],
    "SA": [(5000, 5999)],
    "WA": [(6000, 6999)],
    "TAS": [(7000, 7999)],
    "NT": [(800, 999)],
}

# Time zone of each state; anything else is Sydney time.
TIME_ZONES = {
    "WA": "Australia/Perth", "SA": "Australia/Adelaide", "NT": "Australia/Darwin",
    "QLD": "Australia/Brisbane", "NSW": "Australia/Sydney", "VIC": "Australia/Melbourne",
    "TAS": "Australia/Hobart", "ACT": "Australia/Canberra",
}
DEFAULT_TIME_ZONE = "Australia/Sydney"

# Age bands a source text may carry.
AGE_BANDS = [
    "0-4", "5-9", "10-14", "15-19", "20-24", "25-34", "35-44",
    "45-54", "55-64", "65-74", "75-84", "85+",
]

# Spellings of a geographic code type.
CODE_TYPE_ALIASES = {
    "post_code": "postcode", "postal_code": "postcode", "zip": "postcode", "zipcode": "postcode",
    "local_government_area": "lga", "lga_code": "lga",
    "primary_health_network": "phn", "phn_code": "phn",
    "statistical_area_1": "sa1", "statistical_area_2": "sa2",
    "statistical_area_3": "sa3", "statistical_area_4": "sa4",
    "sa1_code": "sa1", "sa2_code": "sa2", "sa3_code": "sa3", "sa4_code": "sa4",
}

# Allocation method and confidence by code type.
ALLOCATION = {
    "postcode": ("population_weighted", 0.95), "lga": ("area_weighted", 0.85),
    "phn": ("health_service_weighted", 0.8), "sa1": ("direct", 1.0), "sa2": ("direct", 1.0),
    "sa3": ("area_weighted", 0.9), "sa4": ("area_weighted", 0.8),
}

# Major centres (latitude, longitude).
MAJOR_CENTRES = {
    "sydney": (-33.8688, 151.2093), "melbourne": (-37.8136, 144.9631),
    "brisbane": (-27.4698, 153.0251), "perth": (-31.9505, 115.8605),
    "adelaide": (-34.9285, 138.6007), "canberra": (-35.2809, 149.1300),
    "darwin": (-12.4634, 130.8456), "hobart": (-42.8821, 147.3272),
}

# ICD-10 chapter label by first letters.
ICD_CHAPTERS = [
    ("[AB]", "Infectious and parasitic diseases"),
    ("(C|D[0-3]|D4[0-8])", "Neoplasms"),
    ("D[5-8]", "Blood and immune disorders"),
    ("E", "Endocrine, nutritional and metabolic diseases"),
    ("F", "Mental and behavioural disorders"),
    ("G", "Nervous system diseases"),
    ("I", "Circulatory system diseases"),
    ("J", "Respiratory system diseases"),
    ("K", "Digestive system diseases"),
    ("[VWXY]", "External causes"),
]

# Degree shifts to GDA2020 by source datum.
DATUM_SHIFT = {
    "GDA2020": (0.0, 0.0), "WGS84": (0.0, 0.0),
    "GDA94": (0.06155 / 111000.0, -0.01087 / 111000.0),
    "AGD66": (0.00013, -0.00008), "AGD84": (0.00010, -0.00006),
}

# Midpoint of each five-year age column, and the national median age.
AGE_MIDPOINTS = {
    "age_0_4": 2.5, "age_5_9": 7.5, "age_10_14": 12.5, "age_15_19": 17.5, "age_20_24": 22.5,
    "age_25_29": 27.5, "age_30_34": 32.5, "age_35_39": 37.5, "age_40_44": 42.5,
    "age_45_49": 47.5, "age_50_54": 52.5, "age_55_59": 57.5, "age_60_64": 62.5,
    "age_65_69": 67.5, "age_70_74": 72.5, "age_75_79": 77.5, "age_80_84": 82.5,
    "age_85_plus": 90.0,
}
NATIONAL_MEDIAN_AGE = 38.4

# Standard population (2021 census) and age multipliers of the overall rate.
STANDARD_POPULATION = {
    "age_0_4": 1565078, "age_5_14": 3114845, "age_15_24": 3320552,
    "age_25_44": 6810434, "age_45_64": 5373771, "age_65_plus": 4315013,
}
AGE_RATE_MULTIPLIER = {
    "age_0_4": 0.2, "age_5_14": 0.1, "age_15_24": 0.3,
    "age_25_44": 0.5, "age_45_64": 1.0, "age_65_plus": 3.0,
}

# Disadvantage labels by decile upper bound, one list per scheme.
DISADVANTAGE = {
    "record": [(3, "Most Disadvantaged"), (5, "Disadvantaged"), (7, "Average"),
               (9, "Advantaged"), (10, "Most Advantaged")],
    "profile": [(2, "Most Disadvantaged"), (4, "Disadvantaged"), (6, "Average"),
                (8, "Advantaged"), (10, "Most Advantaged")],
    "irsd": [(2, "Most Disadvantaged"), (4, "Disadvantaged"), (6, "Middle"),
             (8, "Advantaged"), (10, "Least Disadvantaged")],
    "other_index": [(2, "Lowest"), (4, "Low"), (6, "Middle"), (8, "High"), (10, "Highest")],
    "severity": [(2, "very_high"), (4, "high"), (6, "moderate"), (8, "low"), (10, "very_low")],
}
