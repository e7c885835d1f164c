"""Default parameters.

Fixed values: results depend on these words and numbers, so they are stated as they are. Every
operator takes them as arguments; these are only the defaults.
"""

# Category names left out of the transaction documents.
EXCLUDED_CATEGORIES = ["COUPONS", "Unknown", "CARTES-CADEAUX-C", "DEPOT BOUTEILLE", "FOURNITURES-SACS"]

# Departments that are not food when baskets are matched.
NON_FOOD_DEPARTMENTS = [
    "Fuel", "NON-ALIMENTAIRE", "REVUES ET JOURNAUX", "DEPENSES", "REVENUS DE SERVICE (NON-INV)",
    "SERVICE POSTAL", "CARTES-CADEAUX", "BILLETS DE LOTERIE", "SANTE ET BEAUTE", "PROPANE EN VRAC",
    "CARTES-CADEAUX COUCHE-TARD", "CARTES TELEPHONIQUES", "BILLETS DE TRANSPORT", "DEPENSES SBT",
    "RETOUR BOUTEILLE", "CARTES-BANNIERES", "PRODUITS LEVEE DE FONDS", "LAVE-AUTO",
    "CARTES PREP INVENTAIRE", "Unknown", "BUREAU DE POSTE", "TOO GOOD TO GO", "CIGARETTES", "TABAC",
]

# Departments and categories outside the elasticity study.
ELASTICITY_EXCLUDED_DEPARTMENTS = [
    "NON-ALIMENTAIRE", "CARTES-CADEAUX", "BILLETS DE TRANSPORT", "DEPENSES",
    "REVENUS DE SERVICE (NON-INV)", "CIGARETTES", "TABAC", "CARTES TELEPHONIQUES", "PROPANE EN VRAC",
    "GNFR DEPENSE", "DEPENSES SBT", "Fuel", "CARTES-BANNIERES", "LAVE-AUTO", "SERVICE POSTAL",
    "BILLETS DE LOTERIE", "PRODUITS NON SCANNES", "RETOUR BOUTEILLE", "CARTES PREP INVENTAIRE",
    "EPICERIE", "BIERE", "VIN ET ALCOOL", "Unknown", "SANTE ET BEAUTE", "REVUES ET JOURNAUX",
    "TOO GOOD TO GO", "PRODUITS LEVEE DU FOND", "CARTES-CADEAUX COUCHE-TARD",
]
ELASTICITY_EXCLUDED_CATEGORIES = [
    "EXTRAS ET ACCOMPAGNEMENTS", "TREMPETTES", "NON-ALIMENTAIRE-C", "PRODUITS LEVEE DE FONDS-C",
    "RESTAURANT PIZZA PIZZA", "MANDAT POSTE-C", "BUREAU POSTE/FRAIS",
]
CATEGORY_ALIASES = {"BREUVAGES_FROIDS": "BOISSONS_GAZEUSES"}

# Brands sold under the retailer's own label.
PRIVATE_BRANDS = [
    "BREUVAGES CHAUDS", "BREUVAGES GLACES", "CK/CT", "CK/CT ARIZONA", "CK/CT MONDOUX",
    "COUCHE-TARD MENU", "FFF", "FONTAINE (POLAR POP)", "JOKER MAD",
]

# Items never mined, and items never modelled.
BASKET_DROP_ITEMS = [
    "Super", "Reg.", "BLEUE DRY 10.1% (1X740ML-C)", "BUDWEISER (6X)473ML-C", "LOTO VALIDEUSE",
    "MACDONALD ORIG REG 20", "FDD BC 0.10", "FDD EAU 0.10", "FDD EAU 0.50", "FDD GM 0.50",
]
SERIES_DROP_PREFIX = "FDD"
SERIES_DROP_ITEMS = [
    "DARE REAL FRUIT MINI 12.5G(X)", "Super", "Reg.", "BUDWEISER (6X)473ML-C",
    "BLEUE DRY 10.1% (1X740ML-C)", "LOTO VALIDEUSE", "MACDONALD ORIG REG 20",
]

# Manufacturers that may not share a bundle.
COMPETING_MANUFACTURERS = [("COKE", "PEPSI"), ("RED BULL", "MONSTER"), ("PEPSI", "MONSTER")]

# Regular prices set by hand, and the lowest legal prices.
REGULAR_PRICE_OVERRIDES = {"LACTANTIA LAIT HOMO.3.25% 4L": 10.99}
PRICE_FLOORS = {
    "LACTANTIA LAIT 2% 1L": 2.11, "LACTANTIA LAIT 2% 2L": 4.17,
    "LACTANTIA LAIT 2% 4L": 7.97, "LACTANTIA LAIT HOMO.3.25% 4L": 8.33,
}

# Words that mark a comment as being about vegetarian food.
VEGE_KEYWORDS = [
    "vegetarian", "vegan", "veggie", "vege", "plant-based", "plant based", "meatless", "no meat",
    "vegatarian", "veg", "vgt", "meat", "processed meat", "processed", "animal products", "trust",
]

# Bundles shown in the survey.
SURVEY_COMBOS = {
    "combo1_size2": ["MUFFIN MORCEAUX CHOCOLAT", "R.GRILL HOT DOG"],
    "combo2_size2": ["COLLATION FRUITS ET FROMAGE", "PANINI AU STEAK"],
    "combo3_size3": ["COLLATION FRUITS ET FROMAGE", "PANINI AU STEAK", "RED BULL 250ML"],
    "combo4_size4": ["BAGUETTINE AU JAMBON", "LAY'S CLASSIC 66g", "PEPSI 591ML", "ESKA 500ML"],
    "combo5_size4": ["MUFFIN MORCEAUX CHOCOLAT", "R.GRILL HOT DOG", "RED BULL SANS SUCRE 250ML",
                     "MOYEN CAFE REGULIER"],
    "combo6_size4": ["BAGUETTINE AU JAMBON", "CHOCOLATINE", "RED BULL 250ML", "PEPSI 591ML",
                     "EAU SOURCE 500ML"],
}
ENGAGEMENT_BINS = [(1.0, "None"), (33.0, "Low"), (55.0, "Medium"), (100.0, "High")]

# Horizon and periods of the pricing study.
OFFER_MONTHS = [4, 5, 6, 7, 8, 9, 10]
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
    "November", "December",
]
JUMP_DATE = "2025-01-17"
FORECAST_START, FORECAST_END = "2025-01-18", "2025-10-01"
OFFER_START, OFFER_END = "2025-04-01", "2025-10-01"
