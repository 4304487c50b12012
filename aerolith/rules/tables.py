"""Fixed values. They must equal those of the data's producers for results to agree; nothing here is computed."""

# Event validation: limits and reasons, in the order in which the rules are tried.
MIN_TITLE_LENGTH = 3
MAX_DURATION_DAYS = 90
PAST_TOLERANCE_DAYS = 90
FUTURE_TOLERANCE_YEARS = 5
VALIDATION_REASONS = (
    "missing_title", "title_too_short", "missing_source_url", "missing_category", "missing_country", "invalid_start_date",
    "invalid_end_date", "end_before_start", "duration_exceeds_max", "ended_too_long_ago", "starts_too_far_in_future",
    "invalid_icao", "invalid_coordinates",
)
NORMAL_SKIP_REASONS = ("unchanged", "concurrent_insert", "lower_priority_duplicate")

# Priorities of event sources; unknown sources have the default.
SOURCE_PRIORITY = {
    "dulv.de": 100, "aero-expo.com": 100, "nbaa.org": 100, "eurocontrol.int": 100, "vereinsflieger.de": 90, "ics-feed": 90,
    "ulforum.de": 60, "iata.org": 40, "fliegermagazin.de": 20, "pilot-frank.de": 20, "pilotenausbildung.net": 10,
}
DEFAULT_PRIORITY = 50

# Locales of translated columns.
LANGS = ("en", "de", "fr", "es", "it", "pl", "cs", "sv", "nl", "pt", "ru", "tr", "el", "no")
# What the list of locales must be on both sides of the tables: its length, first and last.
EXPECTED_LANGS = (14, "en", "no")


def check_langs(langs=LANGS) -> None:
    """Raises if the list of locales isn't the one that the target tables have columns for."""
    if (len(langs), langs[0], langs[-1]) != EXPECTED_LANGS:
        raise ValueError(f"locales: {EXPECTED_LANGS} expected, {len(langs)} from {langs[0]} to {langs[-1]} found")


check_langs()

# Letters that become other letters in slugs; those that become several are apart.
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "yo", "ж": "zh", "з": "z", "и": "i", "й": "y", "к": "k",
    "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts",
    "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya",
}
GREEK = {
    "α": "a", "β": "v", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "i", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m",
    "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "y", "φ": "f", "χ": "ch", "ψ": "ps",
    "ω": "o",
}
TURKISH = {"ı": "i", "ğ": "g", "ü": "u", "ş": "s", "ö": "o", "ç": "c", "İ": "i"}

# Month names.
GERMAN_MONTHS = {
    "januar": "01", "jan": "01", "februar": "02", "feb": "02", "märz": "03", "mar": "03", "april": "04", "apr": "04",
    "mai": "05", "juni": "06", "jun": "06", "juli": "07", "jul": "07", "august": "08", "aug": "08", "september": "09",
    "sep": "09", "oktober": "10", "okt": "10", "november": "11", "nov": "11", "dezember": "12", "dez": "12",
}
ENGLISH_MONTHS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
    "january": 1, "february": 2, "march": 3, "april": 4, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10,
    "november": 11, "december": 12,
}
FULL_GERMAN_MONTHS = {
    "januar": 1, "februar": 2, "märz": 3, "maerz": 3, "april": 4, "mai": 5, "juni": 6, "juli": 7, "august": 8, "september": 9,
    "oktober": 10, "november": 11, "dezember": 12,
}

# Makers' names: what a title says -> the name that is stored.
MANUFACTURER_ALIASES = {
    "agustawestland": "Leonardo", "agusta westland": "Leonardo", "agusta": "Leonardo", "eurocopter": "Airbus Helicopters",
    "mbb": "Airbus Helicopters", "aerospatiale": "Airbus Helicopters", "sikorski": "Sikorsky", "hawker beechcraft": "Beechcraft",
    "daher-socata": "Daher", "daher socata": "Daher", "dehavilland": "De Havilland", "de havilland canada": "De Havilland",
    "partenavia": "Vulcanair", "ikarus": "Comco Ikarus", "comco ikarus": "Comco Ikarus", "fk9": "FK Lightplanes",
    "fk14": "FK Lightplanes", "fk lightplanes": "FK Lightplanes", "i.c.p": "ICP",
}

# Categories of aircraft by what URL or title hold, in the order in which they are tried: parts of the URL, parts of the
# title, patterns of the title. W stands for a place where no word goes on.
CATEGORY_RULES = (
    ("Helicopter / Gyrocopter", ("/hubschrauber", "/helicopter"), ("helicopter", "hubschrauber", "gyrocopter", "autogyro", "tragschrauber"), ()),
    ("Glider", ("/segelflugzeug", "/glider"), ("glider", "segelflugzeug", "sailplane", "motorsegler", "motor glider", "tmg"), ()),
    ("Microlight / Flex-Wing", ("/trike",), ("flex-wing", "flexwing", "paramotor", "motorschirm", "drachenflieger", "hängedrachen", "hängegleiter", "weight-shift", "drachenfläche"), (r"\btrike\b",)),
    ("Turboprop", ("/turboprop",), ("turboprop", "turbo prop", "king air", "tbm ", "pc-12", "caravan", "meridian", "cheyenne", "conquest", "epic e1000", "kodiak"), ()),
    ("Jet", ("/jet",), ("citation", "phenom", "learjet", "gulfstream", "falcon ", "challenger", "global ", "canadair", "hondajet", "hawker", "praetor", "legacy 5", "legacy 6", "latitude", "longitude", "beechjet", "embraer ", "bombardier ", "sf50", "vision jet"), (r"\bjet\b",)),
    ("Multi Engine Piston", ("/multiprop", "/mehrmotorig"), ("twin", "multi engine", "zweimotorig", "baron", "seneca", "seminole", "duchess", "apache", "da42", "da62", "p2006", "tecnam p2006", "cessna 310", "cessna 340", "cessna 414", "cessna 421", "piper aztec", "piper navajo"), ()),
    ("Single Engine Piston", ("/singleprop", "/einmotorig", "/kolbenmotorflugzeug"), (
        "yakovlev", "sukhoi su-26", "sukhoi su-29", "sukhoi su-31", "nanchang", "extra 200", "extra 300", "extra 330", "cap 10", "cap 20", "cap 21", "cap 232",
        "pitts ", "one design", "mxs-r", "gamebird", "cessna 150", "cessna 152", "cessna 170", "cessna 172", "cessna 175", "cessna 177", "cessna 180",
        "cessna 182", "cessna 185", "cessna 195", "cessna 205", "cessna 206", "cessna 207", "cessna 210", "piper pa-18", "piper pa-22", "piper pa-24",
        "piper pa-28", "piper pa-32", "piper pa-46", "cherokee", "warrior", "archer", "dakota", "saratoga", "lance ", "arrow", "cub", "bonanza", "debonair",
        "musketeer", "sundowner", "sierra", "mooney m20", "mooney ovation", "mooney acclaim", "cirrus sr", "sr20", "sr22", "diamond da20", "diamond da40",
        "robin dr", "grumman aa", "tiger aa5", "bellanca ", "stinson ", "t-6 texan", "harvard", "t-34 mentor", "nord 3202", "fouga magister", "chipmunk",
    ), (r"\byak[-\s]?(3|7|9|11|18|50|52|54|55)\b", r"\bcj-?6\b", r"\bzlin\b", r"\bz-?(42|43|50|142|143|242|526|726)\b", r"\bdr[- ]?400\b")),
    ("Experimental / Homebuilt", ("/experimental",), ("experimental", "eigenbau", "homebuilt", "kit-built", "kitbuilt", "selbstbau", "lancair", "glasair", "sonex", "kitfox"), (r"\brv-?(3|4|6|7|8|9|10|12|14)\b",)),
    ("Commercial Airliner", (), ("airliner", "verkehrsflugzeug", "boeing 7", "airbus a3"), ()),
    ("Ultralight / Light Sport Aircraft (LSA)", ("/ul-", "/ultraleicht", "ul-flugzeug", "helmuts-ul-seiten.de"), (
        "ultralight", "ultraleicht", " ul ", "sonaca", "flight design ct", "flight design f", "comco ikarus", "ikarus c42", "ikarus c-42", "c42", "breezer", "bristell",
        "shark aero", "blackshape", "lambada", "wt-9", "wt9", "dynamic wt", "fk9", "fk 9", "fk14", "fk 14", "fk-lightplanes", "b&f fk", "eurofox", "eurostar", "p92",
        "p2002", "tecnam p92", "tecnam p2002", "tecnam p96", "savannah", "savage cub", "sportcruiser", "piper sport", "virus sw", "pipistrel",
    ), (r"\bul\b", r"\blsa\b")),
)

# Categories by the form of a registration, in the order in which they are tried.
REGISTRATION_CATEGORIES = (
    ("D-[AB][A-Z]{2,3}", "Commercial Airliner"), ("D-C[A-Z]{2,3}", "Jet"), ("D-E[A-Z]{2,3}", "Single Engine Piston"),
    ("D-F[A-Z]{2,3}", "Turboprop"), ("D-G[A-Z]{2,3}", "Multi Engine Piston"), ("D-H[A-Z]{2,3}", "Helicopter / Gyrocopter"),
    ("D-I[A-Z]{2,3}", "Multi Engine Piston"), ("D-K[A-Z]{2,3}", "Glider"), ("D-M[A-Z]{3}", "Ultralight / Light Sport Aircraft (LSA)"),
    ("D-N[A-Z]{3}", "Microlight / Flex-Wing"), (r"D-\d{4}", "Glider"),
    ("OE-[AC][A-Z]{2}", "Single Engine Piston"), ("OE-B[A-Z]{2}", "Commercial Airliner"), ("OE-[DK][A-Z]{2}", "Single Engine Piston"),
    ("OE-E[A-Z]{2}", "Turboprop"), ("OE-F[A-Z]{2}", "Multi Engine Piston"), ("OE-G[A-Z]{2}", "Jet"), ("OE-H[A-Z]{2}", "Jet"),
    ("OE-[IL][A-Z]{2}", "Commercial Airliner"), ("OE-X[A-Z]{2}", "Helicopter / Gyrocopter"), ("OE-W[A-Z]{2}", "Single Engine Piston"),
    ("HB-[CDEHKNOPSTU][A-Z]{2}", "Single Engine Piston"), ("HB-F[A-Z]{2}", "Turboprop"), ("HB-[GL][A-Z]{2}", "Multi Engine Piston"),
    ("HB-A[A-Z]{2}", "Turboprop"), ("HB-[IJ][A-Z]{2}", "Commercial Airliner"), ("HB-V[A-Z]{2}", "Jet"), ("HB-M[A-Z]{2}", "Single Engine Piston"),
    ("HB-R[A-Z]{2}", "Single Engine Piston"), ("HB-W[A-Z]{2}", "Ultralight / Light Sport Aircraft (LSA)"),
    ("HB-[XZ][A-Z]{2}", "Helicopter / Gyrocopter"), ("HB-Y[A-Z]{2}", "Experimental / Homebuilt"),
)

# Countries by the start of a registration, in the order in which they are tried.
REGISTRATION_COUNTRIES = (
    ("D-", "Germany"), ("OE-", "Austria"), ("HB-", "Switzerland"), ("F-", "France"), ("G-", "United Kingdom"), ("I-", "Italy"), ("EC-", "Spain"),
    ("PH-", "Netherlands"), ("OO-", "Belgium"), ("SP-", "Poland"), ("OK-", "Czech Republic"), ("SE-", "Sweden"), ("LN-", "Norway"), ("OY-", "Denmark"),
    ("OH-", "Finland"), ("SX-", "Greece"), ("TC-", "Turkey"), ("HA-", "Hungary"), ("YR-", "Romania"), ("9A-", "Croatia"), ("OM-", "Slovakia"),
    ("S5-", "Slovenia"), ("LZ-", "Bulgaria"), ("EI-", "Ireland"), ("EJ-", "Ireland"), ("TF-", "Iceland"), ("ES-", "Estonia"), ("YL-", "Latvia"),
    ("LY-", "Lithuania"), ("LX-", "Luxembourg"), ("9H-", "Malta"), ("CS-", "Portugal"), ("CR-", "Portugal"), ("UR-", "Ukraine"), ("N", "United States"),
    ("C-", "Canada"), ("CF-", "Canada"), ("VH-", "Australia"), ("ZK-", "New Zealand"), ("ZL-", "New Zealand"), ("ZM-", "New Zealand"),
    ("ZS-", "South Africa"), ("ZT-", "South Africa"), ("ZU-", "South Africa"), ("PP-", "Brazil"), ("PR-", "Brazil"), ("PT-", "Brazil"), ("PU-", "Brazil"),
    ("JA-", "Japan"), ("RA-", "Russia"), ("RF-", "Russia"), ("9V-", "Singapore"), ("VT-", "India"), ("B-", "China"),
)

# ICAO codes: starts that are taken for airfields, in listings and in free text, and the countries of some.
ICAO_STARTS = "ED|ET|LO|LS|LF|LE|LI|EH|EB|EP|LK|ES|EN|EK|LG|LT|LH|LR|LD|EG|EI|BI|EV|EY|EE|LJ|LM|LP|LC|LW|LN|LA|UK|UU|K|CY|PA|PH"
ICAO_TEXT_STARTS = "ED|LO|LS|EG|LF|EB|LP|LE|LK|EP|EH|LI|EK|ES|EN|EF"
ICAO_COUNTRIES = {
    "ED": "Germany", "LO": "Austria", "LS": "Switzerland", "EG": "United Kingdom", "LF": "France", "EB": "Belgium", "LP": "Portugal", "LE": "Spain",
    "LK": "Czech Republic", "EP": "Poland", "EH": "Netherlands", "LI": "Italy", "EK": "Denmark", "ES": "Sweden", "EN": "Norway", "EF": "Finland",
}

# Names of countries that are not cities, English names of German ones, and words that are no part of a city's name.
COUNTRY_NAMES = (
    "germany", "deutschland", "france", "frankreich", "spain", "spanien", "italy", "italien", "austria", "österreich", "oesterreich", "switzerland", "schweiz",
    "netherlands", "niederlande", "holland", "belgium", "belgien", "poland", "polen", "czech republic", "tschechien", "sweden", "schweden", "norway", "norwegen",
    "denmark", "dänemark", "portugal", "greece", "griechenland", "turkey", "türkei", "united kingdom", "uk", "usa", "united states", "canada", "kanada",
    "hungary", "ungarn", "romania", "rumänien", "croatia", "kroatien", "slovakia", "slowakei", "slovenia", "slowenien", "bulgaria", "bulgarien",
)
COUNTRY_ENGLISH = {
    "deutschland": "Germany", "frankreich": "France", "spanien": "Spain", "italien": "Italy", "österreich": "Austria", "oesterreich": "Austria",
    "schweiz": "Switzerland", "niederlande": "Netherlands", "holland": "Netherlands", "belgien": "Belgium", "polen": "Poland", "tschechien": "Czech Republic",
    "schweden": "Sweden", "norwegen": "Norway", "dänemark": "Denmark", "griechenland": "Greece", "türkei": "Turkey", "ungarn": "Hungary", "rumänien": "Romania",
    "kroatien": "Croatia", "slowakei": "Slovakia", "slowenien": "Slovenia", "bulgarien": "Bulgaria", "kanada": "Canada",
}
NOT_CITY_WORDS = (
    "factory", "available", "maintenance", "man", "flugplatz", "airport", "hangar", "lagerung", "werkstatt", "museum", "studio", "office", "base", "depot",
    "storage", "verkauf", "verkaufe", "verkaufen", "privatverkauf", "biete", "angeboten", "angebot", "suche", "trike", "cessna", "piper", "beechcraft",
    "diamond", "cirrus", "mooney", "rotax", "lycoming", "continental", "jabiru", "motor", "propeller", "baujahr", "betriebsstunden", "stunden", "flugstunden",
    "preis", "einsitzer", "doppelsitzer", "ultraleicht", "ultralight", "experimental", "sportflugzeug", "flugzeug", "aircraft", "airplane", "plane", "fallen",
    "defekt", "beschädigt", "unfall", "unfälle", "crashed", "telefon", "email", "kontakt", "contact", "noreply", "info", "hersteller", "manufacturer",
    "modell", "model", "type", "typ",
)
CITY_COUNTRY_PREFIXES = "Deutschland|Italien|Frankreich|Spanien|Schweiz|Österreich|Germany|Italy|France|Spain|Switzerland|Austria|Oesterreich|Dänemark|Denmark|Polen|Poland|Ungarn|Hungary|Tschechien|Niederlande|Netherlands|Belgien|Belgium"
CITY_PLACE_PREFIXES = "Flugplatz|Flughafen|Airport|Airfield|Standort|Raum|Region|Nähe|bei|near|in"
CITY_TRAILERS = "Lagerung|Hangar|Unfall|Werkstatt|Museum|Privatverkauf|Verkauf|Baujahr|BJ|Motor|Rotax|Standort|Flugplatz|Flughafen|southwest|northwest|northeast|southeast|NM|km|Stunden|Betriebsstunden"

# ISO codes of countries, as geocoding keys and event pages name them.
COUNTRY_ISO = {
    "germany": "DE", "deutschland": "DE", "austria": "AT", "österreich": "AT", "switzerland": "CH", "schweiz": "CH", "france": "FR", "italy": "IT", "italia": "IT",
    "spain": "ES", "españa": "ES", "poland": "PL", "polska": "PL", "czech republic": "CZ", "czechia": "CZ", "sweden": "SE", "netherlands": "NL", "portugal": "PT",
    "russia": "RU", "turkey": "TR", "türkiye": "TR", "greece": "GR", "norway": "NO", "united kingdom": "GB", "uk": "GB", "great britain": "GB",
    "united states": "US", "usa": "US", "united states of america": "US", "canada": "CA",
}
VENUE_COUNTRY_ISO = {
    "france": "FR", "germany": "DE", "switzerland": "CH", "belgium": "BE", "italy": "IT", "spain": "ES", "uk": "GB", "united kingdom": "GB", "ireland": "IE",
    "united states": "US", "usa": "US", "canada": "CA", "mexico": "MX", "brazil": "BR", "argentina": "AR", "uae": "AE", "united arab emirates": "AE",
    "qatar": "QA", "saudi arabia": "SA", "jordan": "JO", "egypt": "EG", "morocco": "MA", "south africa": "ZA", "india": "IN", "china": "CN", "japan": "JP",
    "singapore": "SG", "korea": "KR", "south korea": "KR", "malaysia": "MY", "thailand": "TH", "indonesia": "ID", "vietnam": "VN", "australia": "AU",
    "new zealand": "NZ", "netherlands": "NL", "poland": "PL", "turkey": "TR", "türkiye": "TR", "turkiye": "TR", "greece": "GR", "hungary": "HU",
    "bahrain": "BH", "oman": "OM", "kenya": "KE", "nigeria": "NG", "ethiopia": "ET", "philippines": "PH", "taiwan": "TW", "pakistan": "PK",
    "hong kong": "HK", "macau": "MO",
}
TEXT_COUNTRIES = (
    ("usa|united states|us", "US"), ("uk|united kingdom|gb|great britain|england|wales|scotland", "GB"), ("belgien|belgium", "BE"), ("brüssel|brussels|brussel", "BE"),
    ("frankreich|france", "FR"), ("österreich|oesterreich|austria", "AT"), ("schweiz|switzerland|suisse", "CH"), ("italien|italy", "IT"),
    ("spanien|spain|españa|espana", "ES"), ("niederlande|netherlands|holland", "NL"), ("tschechien|czech", "CZ"), ("polen|poland", "PL"),
)

# Categories of events: codes, those of one source by number, and patterns by source in the order in which they are tried.
EVENT_CATEGORIES = ("seminar", "competition", "flying-camp", "airfield-festival", "trade-fair", "airshow", "auction", "webinar", "meetup", "general")
CATEGORY_NUMBERS = {1: "seminar", 2: "competition", 3: "flying-camp", 4: "airfield-festival", 5: "trade-fair", 6: "general"}
EVENT_RULES = {
    "dulv.de": (("airshow|flugshow|flugtag", "airshow"), (r"wettbewerb|meisterschaft|\bdm\b|cup\b|championship", "competition"), ("seminar|fortbildung|schulung|lehrgang|infotag|infotage", "seminar"), (r"messe|trade fair|expo\b", "trade-fair"), (r"fly[-\s]?in|treffen|festival|pilotenparty", "meetup"), ("", "meetup")),
    "iata.org": (("forum|symposium|summit", "seminar"), ("conference|congress|meeting|agm", "seminar"), ("expo|exhibition|fair", "trade-fair"), ("awards|gala", "general"), ("", "seminar")),
    "ulforum.de": (("airshow|flugshow|flugtag", "airshow"), (r"wettbewerb|meisterschaft|cup\b", "competition"), ("seminar|fortbildung|schulung", "seminar"), (r"messe|trade fair|expo\b", "trade-fair"), (r"fly[-\s]?in|pilotentreffen|treffen", "meetup"), ("", "meetup")),
    "pilot-frank.de": (("airshow|flugshow|flugtag", "airshow"), (r"wettbewerb|meisterschaft|cup\b", "competition"), ("seminar|fortbildung|schulung", "seminar"), (r"messe|expo\b|aero\b", "trade-fair"), (r"fly[-\s]?in|pilotentreffen|treffen|hangar", "meetup"), ("", "general")),
    "nbaa.org": ((r"convention|exhibition|expo|bace\b", "trade-fair"), ("seminar|workshop|course|pdp", "seminar"), ("conference|symposium|forum|summit", "seminar"), ("awards|gala", "general"), ("", "seminar")),
    "eurocontrol.int": (("forum|symposium|summit|conference|congress|meeting", "seminar"), ("workshop|webinar|training|course", "seminar"), ("awards|gala", "general"), ("", "seminar")),
    "fliegermagazin.de": (("flugtag", "airfield-festival"), ("messe|expo", "trade-fair"), ("airshow|flugshow", "airshow"), ("seminar|schulung", "seminar"), ("wettbewerb", "competition"), (r"fly[-\s]?in|treffen", "meetup"), ("", "general")),
}

# Headings of parts sections, in the order in which they are tried, and the numbers of parts categories.
PARTS_HEADINGS = (
    ("avionik|navigationsger|transponder|funkger|avionics", "avionics"), (r"motor(?:en)?(?:\s|/|$)|triebwerk|engine", "engines"), ("propeller|luftschraube", "propellers"),
    ("instrument|anzeige|cockpit", "instruments"), ("rettung|rettungsger|rettungssystem|fallschirm", "rescue"), ("sonstig|zubehör|diverses|misc", "miscellaneous"),
)

# Text marks: navigation blocks, avionics, headings of one aircraft site's URLs.
NAVIGATION_WORDS = ("startseite", "navigation", "impressum", "datenschutz", "cookie", "seitennavigation", "home")
AVIONICS_WORDS = ("GPS", "Transponder", "Funke", "VOR", "ILS", "ADS-B", "FLARM", "Autopilot", "Garmin", "Dynon", "Becker", "Trig", "Bendix", "King", "SkyDemon", "SkyView", "XPNDR", "Mode-S", "Mode-C", "TCAS")
DETAIL_AVIONICS_WORDS = ("GPS", "Transponder", "Funk", "VOR", "ILS", "ADS-B", "FLARM", "Autopilot", "Garmin", "Dynon", "Becker", "Trig", "Bendix", "King", "SkyDemon", "SkyView", "XPNDR", "Mode-S", "Mode-C", "TCAS", "Stormscope")
URL_CATEGORY_HINTS = {
    "singleprop": "Single Engine Piston", "multiprop": "Multi Engine Piston", "turboprop": "Turboprop", "jet": "Jet", "helicopter": "Helicopter / Gyrocopter",
    "ultralight": "Ultralight / Light Sport Aircraft (LSA)", "motorglider": "Glider", "glider": "Glider",
}

# Models: patterns of which any makes a string unfit for a model's name (besides its length and number of words).
NOT_MODEL = (
    r"^(rotax|lycoming|continental|jabiru|hirth|polini|bmw|teledyne|superior)\b", r"^\s*(rotax\s*)?91[2456]\s*(i?s|uls|ul|is)?\s*$", r"^\s*(rotax\s*)?(582|503|447)\s*(uls|ul)?\s*$",
    r"^(t?s?io?-?(200|240|300|320|346|360|470|520|540|550))\b", r"^(aeio|t?io|o)-?(235|290|320|360|390|480|540|580|720)\b", r"^(jabiru\s*)?(2200|3300)\b",
    r"^[A-Z]{1,2}-[A-Z]{2,4}\b", r"^N\d{1,5}[A-Z]{0,2}$", r"^\d{1,3}([.,]\d{3})*\s*(€|EUR|,-)?$", "@",
    r"\b(zustand|verkauf|baujahr|stunden|preis|motor\b|biete|kaufe|gesucht|aufgabe|demoflu(?:gzeug)?|versteuert|ttaf|airch|einziehfahrwerk|dynon(?:avionics)?|skyview|equipment|ausstattung|inklusive|instrument(?:ierung)?|neuwertig)",
    r"\bBj\.?\b",
)
SALE_PREFIXES = (r"^(zu\s+)?verkauf[e]?\s*[:.]?\s*", r"^(for\s+)?sale\s*[:.]?\s*", r"^angeboten\s+wird\s*", r"^verkaufe\s*[:.]?\s*", r"^biete\s*[:.]?\s*")
MODEL_ENDS = r"\s+(?:Baujahr|BJ\.?|Betriebsstunden|TT:|TTAF|Motor:|Standort|Zustand|Preis|EUR|€|\d{2}\.\d{2}\.\d{4})"
PARTS_CATEGORY_IDS = {"avionics": 1, "engines": 2, "propellers": 3, "rescue": 5, "miscellaneous": 5, "instruments": 6}

# Images: hosts that are allowed, marks of advertisements, and first bytes of formats.
IMAGE_HOSTS = ("www.helmuts-ul-seiten.de", "helmuts-ul-seiten.de", "www.aircraft24.de", "aircraft24.de", "www.aeromarkt.net", "aeromarkt.net")
AD_PATTERNS = ("advertisement", "banner", "sponsor", r"\bad[_-]?\d", "google_ads", "doubleclick")

# Brands of parts, in the order in which they are looked for.
PART_BRANDS = (
    "Rotax", "BRP", "Garmin", "Becker", "Junkers", "Trig", "Funkwerk", "Bose", "David Clark", "Sennheiser", "Dynon", "MGL", "FLARM", "Junkers Profly",
    "Fresh Breeze", "Parajet", "Nirvana", "Vittorazi", "Polini", "Cors-Air", "HKS", "Simonini", "Bailey", "Hirth",
)

# Sections of one event page by parts of their headings, in the order in which they are tried.
EVENT_SECTIONS = (("luftfahrt messen", "trade-fair"), ("airshows", "airshow"), ("flugshows", "airshow"), ("fly-inn", "meetup"), ("pilotentreffen", "meetup"))

# Other names of categories in reference specifications.
CATEGORY_ALIASES = {
    "Helicopter": "Helicopter / Gyrocopter", "Gyrocopter": "Helicopter / Gyrocopter", "Light Sport Aircraft": "Ultralight / Light Sport Aircraft (LSA)",
    "Ultralight": "Ultralight / Light Sport Aircraft (LSA)", "LSA": "Ultralight / Light Sport Aircraft (LSA)", "Experimental": "Experimental / Homebuilt",
    "Homebuilt": "Experimental / Homebuilt", "Microlight": "Microlight / Flex-Wing", "Flex-Wing": "Microlight / Flex-Wing",
}

# Sources: name, base URL, what its pages list, whether its mail invites, and the paths of its first pages.
SOURCES = (
    ("helmuts-ul-seiten.de", "https://www.helmuts-ul-seiten.de", "aircraft", True, ("/verkauf1a.html", "/verkauf1b.html", "/verkauf1c.html")),
    ("helmuts-ul-seiten.de", "https://www.helmuts-ul-seiten.de", "parts", True, ("/verkauf2.html",)),
    ("aircraft24.de", "https://www.aircraft24.de", "aircraft", False, ("/singleprop/index.htm", "/multiprop/index.htm", "/turboprop/index.htm", "/jet/index.htm", "/helicopter/index.htm")),
    ("aeromarkt.net", "https://www.aeromarkt.net", "aircraft", False, (
        "/Kolbenmotorflugzeuge/", "/Kolbenmotorflugzeuge/Leichtflugzeuge-UL-VLA-ELA/", "/Kolbenmotorflugzeuge/Experimentals-Classics/", "/Jets-Turboprops/", "/Helikopter-Gyrocopter/", "/Sonstige-Luftfahrzeuge/",
    )),
    ("aeromarkt.net", "https://www.aeromarkt.net", "parts", False, ("/Triebwerke/", "/Avionik-Instrumente/")),
    ("ics-feed", "", "events", False, ()),
    ("vereinsflieger.de", "https://vereinsflieger.de", "events", False, (
        "/publiccalendar/?category=1", "/publiccalendar/?category=2", "/publiccalendar/?category=3", "/publiccalendar/?category=4", "/publiccalendar/?category=5", "/publiccalendar/?category=6",
    )),
    ("pilotenausbildung.net", "https://pilotenausbildung.net", "events", False, ("/ausflugstipps/",)),
    ("fliegermagazin.de", "https://www.fliegermagazin.de", "events", False, ("/termine/",)),
    ("ulforum.de", "https://www.ulforum.de", "events", False, ("/veranstaltungen",)),
    ("iata.org", "https://www.iata.org", "events", False, ("/en/events/",)),
    ("pilot-frank.de", "https://pilot-frank.de", "events", False, ("/events/feed/",)),
    ("dulv.de", "https://www.dulv.de", "events", False, ("/Veranstaltungen",)),
    ("aero-expo.com", "https://www.aero-expo.com", "events", False, ("/",)),
    ("aero-expo.com", "https://www.aero-expo.de", "events", False, ("/",)),
    ("nbaa.org", "https://nbaa.org", "events", False, ("/events/",)),
    ("eurocontrol.int", "https://www.eurocontrol.int", "events", False, ("/events",)),
)
