"""Fixed values the curation rules depend on: word lists, label tables, formats.

Only data lives here.  Site addresses are not fixed values; they are passed in
as :class:`listwright.settings.Site`.
"""

# --- fixed values: shared by every profile ---------------------------------

MISSING = "N/A"

CURRENCIES = {
    "TND": "TND",
    "DT": "TND",
    "dt": "TND",
    "EUR": "EUR",
    "€": "EUR",
    "USD": "USD",
    "$": "USD",
}

CATEGORIES = {
    "appartement": "apartment",
    "apartment": "apartment",
    "maison": "house",
    "house": "house",
    "villa": "villa",
    "terrain": "land",
    "land": "land",
    "bureau": "office",
    "office": "office",
    "local commercial": "commercial",
    "commercial": "commercial",
    "vente": "sale",
    "location": "rent",
    "rent": "rent",
    "sale": "sale",
}

REQUIRED_FIELDS = ("title", "listing_url", "price")

MIN_IMAGE_WIDTH = 100

# --- fixed values: quality and reporting -----------------------------------

COMPLETENESS_FIELDS = (
    "title",
    "price_numeric",
    "category",
    "location_raw",
    "description",
    "date_posted",
)

# penalty per issue, counted in half points so that all sums stay integers
HALF_POINT_PENALTIES = {
    "missing_required_fields": 4,
    "invalid_prices": 2,
    "missing_images": 1,
    "incomplete_location": 2,
}
HALF_POINTS_PER_LISTING = 20
QUALITY_THRESHOLD = 70.0
TOP_CITIES = 10

# --- fixed values: export ---------------------------------------------------

CSV_LEADING_COLUMNS = (
    "listing_id", "title", "price_numeric", "currency", "price_raw",
    "category", "city", "governorate", "neighborhood", "location_raw",
    "surface", "rooms", "bedrooms", "bathrooms", "floor", "furnished",
    "description", "date_posted", "image_count", "listing_url", "scraped_at",
)
EXPORT_CATEGORY = "immobilier"

# --- fixed values: criteria of the classifieds profile ----------------------

CRITERIA_KEYS = {
    "superficie": "surface",
    "surface_habitable": "surface",
    "surface_area": "surface",
    "chambres": "bedrooms",
    "nombre_de_chambres": "bedrooms",
    "pieces": "rooms",
    "nombre_de_pieces": "rooms",
    "salle_de_bain": "bathrooms",
    "salles_de_bain": "bathrooms",
    "etage": "floor",
    "meuble": "furnished",
}
NUMERIC_CRITERIA = ("surface", "rooms", "bedrooms", "bathrooms", "floor")
BOOLEAN_CRITERIA = ("furnished", "garage", "elevator", "pool", "garden", "balcony")
TRUE_WORDS = ("oui", "yes", "true", "1", "disponible", "available")
TRUTHY_CRITERIA = ("furnished", "garage", "elevator", "pool", "garden")

# --- fixed values: refline profile ------------------------------------------

REFLINE_OPTIONS = (
    "Acces internet",
    "Interphone",
    "Climatisation",
    "Parabole / TV",
    "Terrasses",
    "Piscine",
    "Meuble",
    "Cuisine equipe",
    "Garage",
    "Jardin",
    "Place de parc",
    "Ascenseur",
    "Balcon",
)
REFLINE_FLAGS = {
    "garage": "garage",
    "garden": "jardin",
    "pool": "piscine",
    "furnished": "meuble",
    "terrace": "terrasse",
    "elevator": "ascenseur",
    "balcony": "balcon",
    "parking": "place de parc",
    "air_conditioning": "climatisation",
    "internet": "acces internet",
}
REFLINE_DESCRIPTION_START = ("description",)
REFLINE_DESCRIPTION_END = ("details de bien", "options", "localisation", "* * *")
REFLINE_OPTIONS_START = ("options",)
REFLINE_OPTIONS_END = ("localisation", "contacter lannonceur", "* * *")
REFLINE_NOT_A_PLACE = ("premium", "description")
IMAGE_URL_EXCLUDES = ("logo", "sprite", "facebook", "twitter")

# --- fixed values: portal profile -------------------------------------------

TRANSACTIONS = {
    "sale": "sale",
    "vente": "sale",
    "vendre": "sale",
    "buy": "sale",
    "achat": "sale",
    "rent": "rent",
    "location": "rent",
    "louer": "rent",
}

# property type -> (slug for sale, slug for rent, category)
PROPERTY_TYPES = {
    "logement": ("appartements-a-vendre", "appartements-a-louer", "apartment"),
    "apartment": ("appartements-a-vendre", "appartements-a-louer", "apartment"),
    "appartement": ("appartements-a-vendre", "appartements-a-louer", "apartment"),
    "terrain": ("terrains-a-vendre", "terrains-a-louer", "land"),
    "land": ("terrains-a-vendre", "terrains-a-louer", "land"),
    "house": ("maisons-a-vendre", "maisons-a-louer", "house"),
    "maison": ("maisons-a-vendre", "maisons-a-louer", "house"),
    "villa": ("villas-et-maisons-de-luxe-a-vendre", "villas-et-maisons-de-luxe-a-louer", "villa"),
    "commercial": ("locaux-a-vendre", "locaux-a-louer", "commercial"),
    "local": ("locaux-a-vendre", "locaux-a-louer", "commercial"),
    "office": ("bureaux-a-vendre", "bureaux-a-louer", "office"),
    "bureau": ("bureaux-a-vendre", "bureaux-a-louer", "office"),
}
WHOLE_COUNTRY_LEVEL = "sc"
DEFAULT_LEVEL = "st"

PORTAL_OPTIONS = {
    "garage": "garage",
    "garden": "jardin",
    "terrace": "terrasse",
    "elevator": "ascenseur",
    "pool": "piscine",
    "furnished": "meuble",
    "concierge": "concierge",
    "air_conditioning": "climatisation",
    "central_heating": "chauffage central",
    "security": "securite",
    "double_glazing": "double vitrage",
    "equipped_kitchen": "cuisine equipee",
    "sea_view": "vue sur mer",
    "mountain_view": "vue sur les montagnes",
    "internet": "internet",
}
PORTAL_DETAIL_LABELS = {
    "type de bien": "property_type",
    "type de terrain": "land_type",
    "livraison": "delivery",
    "statut du terrain": "land_status",
    "etat": "condition",
    "standing": "standing",
    "orientation": "orientation",
    "type de sol": "flooring",
    "type du sol": "flooring",
    "etage du bien": "floor",
}
PORTAL_DETAILS_START = ("caracteristiques generales",)
PORTAL_DETAILS_END = ("voir la carte", "contacter lannonceur", "contacter")
PORTAL_DESCRIPTION_STOP = (
    "caracteristiques generales",
    "contacter lannonceur",
    "voir la carte",
    "favori",
    "partager",
)
PORTAL_NOT_A_PLACE = (
    "favori",
    "partager",
    "contacter",
    "demander le prix",
    "voir la carte",
)
PORTAL_NO_PRICE = "prix a consulter"
PORTAL_NO_PRICE_RAW = "Prix a consulter"

# --- fixed values: HTML ------------------------------------------------------

VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input "
    "isindex keygen link menuitem meta nextid param source spacer track wbr".split()
)
# text below these tags is not page text
SILENT_TAGS = frozenset(("script", "style", "template", "rt", "rp"))
VERBATIM_TAGS = frozenset(("pre", "textarea"))
