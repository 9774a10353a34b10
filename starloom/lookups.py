"""Code lists and name corrections that results depend on."""

# Arrival state codes, spelled as in the published code list. Join on the code only.
STATE_CODES = (
    ("AL", "ALABAMA"),
    ("AK", "ALASKA"),
    ("AZ", "ARIZONA"),
    ("AR", "ARKANSAS"),
    ("CA", "CALIFORNIA"),
    ("CO", "COLORADO"),
    ("CT", "CONNECTICUT"),
    ("DE", "DELAWARE"),
    ("DC", "DIST. OF COLUMBIA"),
    ("FL", "FLORIDA"),
    ("GA", "GEORGIA"),
    ("GU", "GUAM"),
    ("HI", "HAWAII"),
    ("ID", "IDAHO"),
    ("IL", "ILLINOIS"),
    ("IN", "INDIANA"),
    ("IA", "IOWA"),
    ("KS", "KANSAS"),
    ("KY", "KENTUCKY"),
    ("LA", "LOUISIANA"),
    ("ME", "MAINE"),
    ("MD", "MARYLAND"),
    ("MA", "MASSACHUSETTS"),
    ("MI", "MICHIGAN"),
    ("MN", "MINNESOTA"),
    ("MS", "MISSISSIPPI"),
    ("MO", "MISSOURI"),
    ("MT", "MONTANA"),
    ("NC", "N. CAROLINA"),
    ("ND", "N. DAKOTA"),
    ("NE", "NEBRASKA"),
    ("NV", "NEVADA"),
    ("NH", "NEW HAMPSHIRE"),
    ("NJ", "NEW JERSEY"),
    ("NM", "NEW MEXICO"),
    ("NY", "NEW YORK"),
    ("OH", "OHIO"),
    ("OK", "OKLAHOMA"),
    ("OR", "OREGON"),
    ("PA", "PENNSYLVANIA"),
    ("PR", "PUERTO RICO"),
    ("RI", "RHODE ISLAND"),
    ("SC", "S. CAROLINA"),
    ("SD", "S. DAKOTA"),
    ("TN", "TENNESSEE"),
    ("TX", "TEXAS"),
    ("UT", "UTAH"),
    ("VT", "VERMONT"),
    ("VI", "VIRGIN ISLANDS"),
    ("VA", "VIRGINIA"),
    ("WV", "W. VIRGINIA"),
    ("WA", "WASHINGTON"),
    ("WI", "WISCONSON"),
    ("WY", "WYOMIN"),
    ("99", "All Other Code"),
)

# Country names of the code list that differ from the temperature data.
COUNTRY_CODE_NAMES = {
    "BOSNIA-HERZEGOVINA": "BOSNIA AND HERZEGOVINA",
    "INVALID: CANADA": "CANADA",
    "CHINA, PRC": "CHINA",
    "GUINEA-BISSAU": "GUINEA BISSAU",
    "INVALID: PUERTO RICO": "PUERTO RICO",
    "INVALID: UNITED STATES": "UNITED STATES",
    "MEXICO Air Sea, and Not Reported (I-94, no land arrivals)": "MEXICO",
}

# Country names of the temperature data that differ from the code list.
TEMPERATURE_NAMES = {
    "Congo (Democratic Republic Of The": "Congo",
    "Côte D'Ivoire": "Ivory Coast",
}

# Census group -> column of the state dimension.
RACES = {
    "American Indian and Alaska Native": "AmericanIndianAndAlaskaNative",
    "Asian": "Asian",
    "Black or African-American": "BlackOrAfricanAmerican",
    "Hispanic or Latino": "HispanicOrLatino",
    "White": "White",
}

# Labels of the coded fact columns.
MODE_LABELS = {1: "air", 2: "sea", 3: "land", 9: "not reported"}
VISA_LABELS = {1: "business", 2: "pleasure", 3: "student"}
