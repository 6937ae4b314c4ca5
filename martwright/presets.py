"""Fixed values of the sales data set. Every function takes them as arguments;
these are only the defaults, and callers with other data pass their own."""

# First and last sale year the marts report on, both inclusive.
BEGIN_YEAR = 2012
END_YEAR = 2021

# Fixed value: county text whose rows are dropped before any repair.
EXCLUDED_COUNTY = "EL PASO"

# Date patterns of the two CSV files.
SALES_DATE_PATTERNS = ("M/d/yyyy",)
POPULATION_DATE_PATTERNS = ("MMMM d yyyy",)

# Text columns that are title-cased by the cleansing job.
TITLE_CASED_COLUMNS = (
    "county",
    "city",
    "store_name",
    "address",
    "category_name",
    "vendor_name",
    "item_description",
)

# Sort order inside each month of the sales table.
CLUSTER_COLUMNS = ("county", "city", "category_name")

# Name of the month partition column that the sales table gets.
MONTH_COLUMN = "sale_month"

# Texts read as missing in non-text columns of a landed CSV.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "n/a",
    "nan",
    "null",
)

# Texts read as missing, in every column, of the raw population file.
POPULATION_NULL_TOKENS = NULL_TOKENS + ("<NA>", "None")

# Misspelt county -> county.
COUNTY_RULES = {
    "BUENA VIST": "Buena Vista",
    "CERRO GORD": "Cerro Gordo",
    "OBRIEN": "O'Brien",
    "POTTAWATTA": "Pottawattamie",
    "O'BRIEN": "O'Brien",
}

# Misspelt city -> city.
CITY_RULES = {
    "DEWITT": "De Witt",
    "GRAND MOUNDS": "Grand Mound",
    "ARNOLD'S PARK": "Arnolds Park",
    "ST LUCAS": "St. Lucas",
    "JEWELL": "Jewell Junction",
    "MT PLEASANT": "Mount Pleasant",
    "LONETREE": "Lone Tree",
    "ST CHARLES": "St. Charles",
    "SAINT ANSGAR": "St. Ansgar",
    "ST ANSGAR": "St. Ansgar",
    "LEMARS": "Le Mars",
    "LECLAIRE": "Le Claire",
    "OTUMWA": "Ottumwa",
    "CLEARLAKE": "Clear Lake",
    "MELCHER-DALLAS": "Melcher-Dallas",
    "FT. ATKINSON": "Fort Atkinson",
    "GUTTENBURG": "Guttenberg",
    "KELLOG": "Kellogg",
    "MCGREGOR": "McGregor",
    "MT VERNON": "Mount Vernon",
    "OTTUWMA": "Ottumwa",
}

# Fixed values: (city, wrong county) -> county.
CITY_COUNTY_RULES = {
    ("BETTENDORF", "IOWA"): "Scott",
    ("CONRAD", "GUTHRIE"): "Grundy",
    ("CORNING", "CLAYTON"): "Adams",
    ("COUNCIL BLUFFS", "MILLS"): "Pottawattamie",
    ("DUBUQUE", "IOWA"): "Dubuque",
    ("FORT DODGE", "IOWA"): "Webster",
    ("FORT DODGE", "HARDIN"): "Webster",
    ("MARTENSDALE", "MARSHALL"): "Warren",
    ("NEWTON", "WEBSTER"): "Jasper",
    ("PERRY", "BOONE"): "Dallas",
    ("PERRY", "CASS"): "Dallas",
    ("WELLMAN", "WAPELLO"): "Washington",
    ("ACKLEY", "WEBSTER"): "Hardin",
    ("CAMBRIDGE", "POLK"): "Story",
    ("COLUMBUS JUNCTION", "BLACK HAWK"): "Louisa",
    ("DAVENPORT", "IOWA"): "Scott",
    ("EDGEWOOD", "IOWA"): "Delaware",
    ("GLADBROOK", "IOWA"): "Tama",
    ("NORTH LIBERTY", "IOWA"): "Johnson",
    ("OSKALOOSA", "BUCHANAN"): "Mahaska",
    ("SHELBY", "HARRISON"): "Shelby",
    ("STATE CENTER", "IOWA"): "Marshall",
    ("SWISHER", "POLK"): "Johnson",
    ("TRAER", "IOWA"): "Tama",
    ("WATERLOO", "IOWA"): "Black Hawk",
    ("WILTON", "IOWA"): "Muscatine",
}
