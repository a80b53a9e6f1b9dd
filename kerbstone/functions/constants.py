"""Word lists, lookup tables and measures that results depend on."""

# Street suffixes and their canonical form.
SUFFIXES = {
    "AV": "AVE", "AVE": "AVE", "AVEN": "AVE", "AVENUE": "AVE",
    "ST": "ST", "STR": "ST", "STREET": "ST",
    "BV": "BLVD", "BL": "BLVD", "BLV": "BLVD", "BLVD": "BLVD", "BOULEVARD": "BLVD",
    "WY": "WAY", "WAY": "WAY", "DR": "DR", "DRIVE": "DR", "RD": "RD", "ROAD": "RD", "LN": "LN", "LANE": "LN",
    "PL": "PL", "PLACE": "PL", "CT": "CT", "COURT": "CT", "CR": "CIR", "CIR": "CIR", "CIRCLE": "CIR",
    "TER": "TER", "TERR": "TER", "TERRACE": "TER", "PKWY": "PKWY", "PY": "PKWY", "PARKWAY": "PKWY",
    "HWY": "HWY", "HIGHWAY": "HWY", "SQ": "SQ", "SQUARE": "SQ", "PATH": "PATH", "WALK": "WALK", "STEPS": "STEPS",
    "PZ": "PLZ", "PLZ": "PLZ", "EXPY": "EXPY", "EXPRESSWAY": "EXPY", "PARK": "PARK", "LOOP": "LOOP",
    "ALY": "ALY", "ALLEY": "ALY", "MALL": "MALL", "MEWS": "MEWS", "CRES": "CRES", "CRESCENT": "CRES", "TRL": "TRL", "TRAIL": "TRL",
}

# Words that lead a name and are dropped, and bounds that end one and are dropped.
LEADING = ["THE", "N", "S", "E", "W", "NB", "SB", "EB", "WB", "NORTH", "SOUTH", "EAST", "WEST"]
BOUNDS = ["NB", "SB", "EB", "WB"]

# Ordinals in words.
ORDINAL_WORDS = {
    "FIRST": "1ST", "SECOND": "2ND", "THIRD": "3RD", "FOURTH": "4TH", "FIFTH": "5TH", "SIXTH": "6TH",
    "SEVENTH": "7TH", "EIGHTH": "8TH", "NINTH": "9TH", "TENTH": "10TH", "ELEVENTH": "11TH", "TWELFTH": "12TH",
}

# Streets that sources name differently, before and after the suffix is put back.
CORE_ALIASES = {
    "M L KING JR": "MARTIN LUTHER KING JR", "M L KING": "MARTIN LUTHER KING JR", "ML KING": "MARTIN LUTHER KING JR",
    "MLK JR": "MARTIN LUTHER KING JR", "MARTIN LUTHER KING": "MARTIN LUTHER KING JR",
    "MARTIN LUTHER KING JR W": "MARTIN LUTHER KING JR", "FLORANCE": "FLORENCE",
    "M L KING JR WAY": "MARTIN LUTHER KING JR WAY", "M L KING WAY": "MARTIN LUTHER KING JR WAY",
    "ML KING WAY": "MARTIN LUTHER KING JR WAY", "MLK JR WAY": "MARTIN LUTHER KING JR WAY",
    "MARTIN LUTHER KING WAY": "MARTIN LUTHER KING JR WAY",
}
FULL_ALIASES = {"MARTIN LUTHER KING JR": "MARTIN LUTHER KING JR WAY"}

# Limits that name a street's end.
TERMINALS = [
    "CITY LIMIT", "CITY LIMITS", "END", "DEAD END", "DEADEND", "CUL DE SAC", "CDS", "TERMINUS", "BEGIN", "START",
    "NORTH END", "SOUTH END", "EAST END", "WEST END", "EAST CITY LIMIT", "WEST CITY LIMIT", "NORTH CITY LIMIT",
    "SOUTH CITY LIMIT", "PAVEMENT END", "END OF PAVEMENT", "END OF STREET", "GATE",
]

# Condition bands, inclusive.
BANDS = [(80, 100, "Very Good / Excellent"), (70, 79, "Good"), (60, 69, "Fair"), (50, 59, "At Risk"), (25, 49, "Poor"), (0, 24, "Failed")]

# Bikeway classes, tiers, and sources in order of trust.
CLASS_LABEL = {
    "I": "Class I - Shared-use path", "II": "Class II - Bike lane", "IIB": "Class II - Upgraded/buffered bike lane",
    "III": "Class III - Bike route", "IIIA": "Class III - Bike route with sharrows",
    "IIIB": "Class III - Bicycle boulevard", "IV": "Class IV - Separated bikeway",
}
OAKLAND_CLASS = {"1": "I", "2": "II", "2B": "IIB", "3": "III", "3A": "IIIA", "3B": "IIIB", "4": "IV"}
BERKELEY_2004 = {"1": "I", "2": "II", "3": "III", "BB - 3": "IIIB", "BB -3": "IIIB"}
TIER_OF = {"I": "protected", "IV": "protected", "II": "painted", "IIB": "painted", "III": "shared", "IIIA": "shared", "IIIB": "shared"}
TIERS = ["protected", "painted", "shared"]
TIER_LABEL = {"protected": "Protected / off-street path", "painted": "Painted bike lane", "shared": "Shared roadway / bike boulevard"}
SOURCE_ORDER = ["Oakland GIS: BikeNetwork", "Berkeley GIS: Separated Bikeways", "Berkeley GIS: Bicycle Boulevards", "OpenStreetMap", "Berkeley GIS: Bikeways (2004 classes)"]
MERGE_ORDER = ["Berkeley GIS: Separated Bikeways", "Berkeley GIS: Bicycle Boulevards", "OpenStreetMap", "Berkeley GIS: Bikeways (2004 classes)"]

# Measures.
FT_PER_M, FT_PER_MILE, M_PER_MILE = 3.280839895, 5280, 1609.344
SNAP_M, NODE_M, BRIDGE_M, LENGTH_TOL, OVERLAP_M = 2.0, 2.0, 30.0, 0.35, 8.0
ON_ROUTE_M, COVERAGE, DEDUP_M, DEDUP_FRAC, MIN_MILES = 12.0, 0.5, 15.0, 0.6, 0.02
LINE_TOLERANCE, LABEL_GAP = 3.0, 16.0
SIMPLIFY_DEG, SCALE = 1e-5, 100_000
