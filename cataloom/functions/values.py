"""Fixed values.

Word lists, lookup tables, limits, patterns and text templates.  The results
depend on these exact values, so they are stated here as plain text.
"""

# --- limits (fixed values) -------------------------------------------------
SEPARATOR = ", "
MAX_KEYWORDS_CHARS = 3000
MAX_COMPANIES_CHARS = 3000
MAX_CAST = 20
MAX_CAST_CHARS = 3000
MAX_OTHER_CREW = 20
MAX_OTHER_CREW_CHARS = 3000
MAX_DEPARTMENT = 10
MAX_DEPARTMENT_CHARS = 800
FEATURE_MINUTES = 58
DOCUMENTARY_PENALTY = 1.5
TITLE_CHARS = 250
URL_CHARS = 500
PERSON_URL_CHARS = 250
HEADQUARTERS_CHARS = 200

# --- format lines (fixed values) -------------------------------------------
COLOR_TECHNOLOGIES = {
    "technicolor": ["technicolor"],
    "eastmancolor": ["eastmancolor", "eastman color"],
    "kodachrome": ["kodachrome"],
    "agfacolor": ["agfacolor"],
    "kinemacolor": ["kinemacolor"],
    "metrocolor": ["metrocolor"],
    "deluxe": ["deluxe color", "de luxe color", "deluxe"],
    "pathécolor": ["pathécolor", "pathecolor"],
    "warnercolor": ["warnercolor"],
    "trucolor": ["trucolor"],
    "anscocolor": ["anscocolor"],
    "cinecolor": ["cinecolor", "cinécolor"],
    "colorfilm": ["colorfilm"],
    "gasparcolor": ["gasparcolor"],
    "sovcolor": ["sovcolor"],
    "gevacolor": ["gevacolor", "geva color", "gévacolor"],
    "fujicolor": ["fujicolor", "fuji color", "fujifilm"],
}

FILM_TECHNOLOGIES = {
    "super_35": ["super 35", "super35"],
    "super_16": ["super 16", "super16"],
    "panavision": ["panavision"],
    "panaflex": ["panaflex"],
    "ultra_panavision": ["ultra panavision"],
    "arriflex": ["arriflex"],
    "vistavision": ["vistavision"],
    "techniscope": ["techniscope"],
    "franscope": ["franscope"],
    "cinemascope": ["cinemascope", "cinémascope"],
    "cinerama": ["cinerama"],
    "todd_ao": ["todd-ao", "todd ao"],
    "d_cinema": ["d-cinema", "d cinema"],
    "dynascreen": ["dynascreen"],
    "polyvision": ["polyvision"],
    "magnascope": ["magnascope"],
    "technirama": ["technirama"],
    "technovision": ["technovision"],
    "tohoscope": ["tohoscope"],
    "panoramique": ["panoramique"],
}

THREE_D_TERMS = ["3d", "3-d"]

SOUND_TECHNOLOGIES = {
    "western_electric": [
        "western electric recording",
        "western electric mirrophonic",
        "western electric noiseless",
        "western electric sound",
        "westrex",
    ],
    "tobis_klangfilm": ["tobis-klangfilm", "tobis klangfilm"],
    "vitaphone": ["vitaphone"],
    "movietone": ["movietone"],
    "perspecta": ["perspecta sound", "perspecta"],
    "sensurround": ["sensurround"],
    "fantasound": ["fantasound"],
    "photophone": ["photophone", "rca photophone"],
    "westrex": ["westrex recording", "westrex sound"],
}

FILM_FORMATS = ["35 mm", "16 mm", "70 mm", "65 mm", "digital", "dcp"]
COLOR_TERMS = ["couleur", "color", "colour"]
BLACK_AND_WHITE_TERMS = ["noir et blanc", "black and white", "b&w", "b/w"]
SILENT_TERMS = ["muet", "silent", "sans son", "sans paroles", "non sonore"]
IGNORED_FORMAT_TERM = "colorworks"

ASPECT_RATIOS = [r"(\d+,\d+):1", r"(\d+\.\d+):1", r"(\d+:\d+)", r"(\d+/\d+)"]
TRACK_COUNT = r"(\d+)[\s-]*(track|piste)"
VALID_COLOR = r"couleur|noir et blanc"
VALID_RATIO = r"\d+[,\.]\d+:\d+|\d+:\d+"
VALID_MEDIUM = r"\d+ mm|digital|dcp"
# "todd ao" is the spelling a cleaned line can still contain
VALID_NAMED_FORMATS = [
    "panavision", "cinemascope", "cinémascope", "cinerama", "todd-ao", "todd ao",
    "vistavision", "techniscope", "super 35", "super 16",
]

TECHNICAL_TYPES = [
    ("color_technology", "COLOR_TECHNOLOGY"),
    ("film_technology", "FILM_TECHNOLOGY"),
    ("sound_technology", "SOUND_TECHNOLOGY"),
    ("sound_system", "SOUND_SYSTEM"),
    ("film_format", "FILM_FORMAT"),
]

# --- dates (fixed value) ---------------------------------------------------
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"

# --- genres, English to French (fixed values) ------------------------------
GENRES_FR = {
    "Action": "Action",
    "Adventure": "Aventure",
    "Animation": "Animation",
    "Comedy": "Comédie",
    "Crime": "Crime",
    "Documentary": "Documentaire",
    "Drama": "Drame",
    "Family": "Familial",
    "Fantasy": "Fantastique",
    "History": "Histoire",
    "Horror": "Horreur",
    "Music": "Musique",
    "Mystery": "Mystère",
    "Romance": "Romance",
    "Science Fiction": "Science-Fiction",
    "Thriller": "Thriller",
    "TV Movie": "Téléfilm",
    "War": "Guerre",
    "Western": "Western",
}

# --- encyclopedia page sections (fixed values) -----------------------------
SECTIONS_SKIPPED = ["Intro", "External links", "References", "See also", "Notes"]
SECTIONS_EXACT = {
    "Cast": "CAST",
    "Plot": "PLOT",
    "Production": "PRODUCTION",
    "Reception": "RECEPTION",
    "Soundtrack": "SOUNDTRACK",
}
SECTIONS_FALLBACK = {
    "Plot summary": "PLOT",
    "Synopsis": "PLOT",
    "Premise": "PLOT",
    "Voice cast": "CAST",
    "Main characters": "CAST",
    "Reception and legacy": "RECEPTION",
    "Release and reception": "RECEPTION",
    "Release": "RECEPTION",
    "Critical response": "RECEPTION",
    "Release history": "RECEPTION",
    "Reception and box office": "RECEPTION",
    "Production notes": "PRODUCTION",
    "Production and release": "PRODUCTION",
    "Development and production": "PRODUCTION",
    "Development": "PRODUCTION",
    "Music": "SOUNDTRACK",
    "Soundtrack and score": "SOUNDTRACK",
}

# --- knowledge-graph properties fetched per movie (fixed values) -----------
PROPERTIES = {
    "P31": "INSTANCE_OF",
    "P7937": "FORM_OF_CREATIVE_WORK",
    "P136": "GENRES",
    "P180": "DEPICTS",
    "P462": "COLOR",
    "P2061": "ASPECT_RATIO",
    "P3803": "ORIGINAL_FILM_FORMAT",
    "P2079": "FABRICATION_METHOD",
    "P750": "DISTRIBUTED_BY",
    "P272": "PRODUCTION_COMPANY",
    "P921": "MAIN_SUBJECT",
    "P840": "NARRATIVE_LOCATION",
    "P915": "FILMING_LOCATION",
    "P674": "CHARACTERS",
    "P161": "CAST",
    "P166": "AWARD_RECEIVED",
    "P144": "BASED_ON",
    "P941": "INSPIRED_BY",
    "P4969": "DERIVATIVE_WORK",
    "P135": "MOVEMENT",
    "P8411": "SET_IN_ENVIRONMENT",
    "P1434": "FICTIONAL_UNIVERSE",
    "P495": "COUNTRY_OF_ORIGIN",
    "P361": "PART_OF",
    "P179": "PART_OF_THE_SERIES",
    "P1343": "DESCRIBED_BY_SOURCE",
    "P195": "COLLECTION",
    "P8345": "MEDIA_FRANCHISE",
    "P2758": "CNC_FILM_RATING",
    "P724": "INTERNET_ARCHIVE",
    "P2408": "SET_IN_PERIOD",
    "P9215": "SET_DURING_EVENT",
}
# fetched but kept out of the keyword document
PROPERTIES_NOT_IN_TEXT = ["P462", "P2061", "P3803", "P2079", "P750", "P272"]

# --- crew departments (fixed values) ---------------------------------------
# department, output column, required job
DEPARTMENTS = [
    ("Directing", "DIRECTORS", "Director"),
    ("Writing", "WRITERS", None),
    ("Production", "PRODUCERS", None),
    ("Editing", "EDITORS", None),
    ("Art", "ART", None),
    ("Camera", "CAMERA", None),
    ("Lightning", "LIGHTNING", None),
    ("Sound", "SOUND", None),
    ("Costume & Make-Up", "COSTUME_MAKEUP", None),
    ("Visual Effects", "VISUAL_EFFECTS", None),
]
OTHER_CREW_COLUMN = "CREW_TOP"
# these three measure the length budget with the aliases appended
ALIAS_BUDGET_COLUMNS = ["DIRECTORS", "WRITERS", "PRODUCERS"]
CREW_DEPARTMENTS_READ = [
    "Art", "Camera", "Directing", "Editing", "Sound", "Writing", "Production",
    "Costume & Make-Up", "Visual Effects",
]

# --- parts of speech kept in lemma text (fixed values) ---------------------
CONTENT_LABELS = ["NOUN", "PROPN", "VERB", "ADJ", "X", "NUM"]

# --- document wording (fixed values) ---------------------------------------
MOVIE_KIND = {"fr": ("film", "documentaire"), "en": ("movie", "documentary")}
FICTION_LABEL = "Film fiction"
LENGTH_LABELS = {
    "fr": ("Long métrage", "Court métrage"),
    "en": ("Feature film", "short film"),
}
CRITERION_LABEL = "Criterion Collection"
CRITERION_SPINE_LABEL = " spine "

# Sentences in output order: (present-test, French, English).
# A test names a field that must be non-empty; None means always.
SENTENCES = [
    ("title", ' "{title}" est un {kind} de {year}', ' "{title}" is a {year} {kind}'),
    ("foreign_title",
     ' dont la langue et le titre original en {language} est "{foreign_title}"',
     ' whose language and original title in {language} is "{foreign_title}"'),
    ("same_title",
     " dont la langue originale est {language}",
     " whose original language is {language}"),
    (None, ".", "."),
    ("alt_title", ' Son titre en anglais est "{alt_title}".', ""),
    ("other_titles",
     " Les autres titres sont: {other_titles}.",
     " The other titles are: {other_titles}."),
    ("fiction", " C'est une fiction.", " This is a fiction."),
    ("genres",
     " Les genres du {kind} sont : {genres}{more_genres}.",
     " {kind} genres are: {genres}{more_genres}."),
    ("feature_minutes",
     " C'est un long métrage de {feature_minutes} minutes.",
     " This is a {feature_minutes} minutes feature film."),
    ("short_minutes",
     " C'est un court métrage de {short_minutes} minutes.",
     " This is a {short_minutes} minutes short film."),
    ("keywords",
     " Les mots-clés du {kind} sont : {keywords}.",
     " {kind} keywords are: {keywords}."),
    ("collection",
     ' Ce {kind} fait partie de la collection "{collection}"',
     ' This {kind} is a part of the "{collection}" collection'),
    ("lists",
     " et il fait partie des listes suivantes : {lists}",
     " and also part of the following lists: {lists}"),
    (None, ".", "."),
    ("criterion", ".", "."),
    ("companies",
     " Les sociétés de production du {kind} sont : {companies}.",
     " Production companies of this {kind} are: {companies}."),
    ("color_technology",
     " Les technologies de couleur du {kind} sont : {color_technology}.",
     " Color technologies of this {kind} are: {color_technology}."),
    ("film_technology",
     " Les technologies cinématographiques du {kind} sont : {film_technology}.",
     " Cinematographic technologies of this {kind} are: {film_technology}."),
    ("sound_system",
     " Les systèmes sonores du {kind} sont : {sound_system}.",
     " Sound systems of this {kind} are: {sound_system}."),
    ("sound_technology",
     " Les technologies sonores du {kind} sont : {sound_technology}.",
     " Sound technologies of this {kind} are: {sound_technology}."),
    ("directors",
     " Le {kind} a été réalisé par {directors}",
     " This {kind} was directed by {directors}"),
    ("writers", " et il a été écrit par {writers}", " and written by {writers}"),
    ("producers", " et il a été produit par {producers}", " and produced by {producers}"),
    (None, ".", "."),
    ("cast",
     " La distribution principale est la suivante : {cast}.",
     " Main cast is with {cast}."),
    ("overview",
     " Voici le résumé du {kind} : {overview}",
     " Here is the {kind} overview: {overview}"),
    ("P921", " Le sujet principal est {P921}.", " The main subject is {P921}."),
    ("P840", " Il se passe à {P840}.", " Narrative location is in {P840}."),
    ("P915", " Il a été tourné à {P915}.", " Filming location is in {P915}."),
    ("P674", " Les personnages du {kind} sont {P674}.", " Characters of the {kind} are {P674}."),
    ("P166", " Il a reçu les prix suivants : {P166}.", " It received the following awards: {P166}."),
    ("P135", " Il fait partie du mouvement {P135}.", " It is part of the {P135} movement."),
    ("P1434", " Il a lieu dans l'univers {P1434}.", " It happens in the {P1434} universe."),
    ("P9215", " Il a lieu pendant {P9215}.", " It is set during {P9215} recurring event."),
]

# Keyword document: fragments in output order.
KEYWORD_FRAGMENTS = [
    "title", "title_lemma", "foreign_title", "alt_title", "alias_words", "year",
    "language", "fiction", "genres_plain", "length_label", "keywords_lemma",
    "collection", "lists_lemma", "criterion", "companies", "color_technology_plain",
    "film_technology_plain", "sound_system_plain", "sound_technology_plain",
    "directors_plain", "writers_plain", "producers_plain", "cast_plain",
    "overview_lemma",
]

# --- stop words of the dictionary tokeniser (own choice) -------------------
STOP_WORDS = {
    "fr": [
        "à", "au", "aux", "avec", "ce", "ces", "cette", "d", "dans", "de", "des", "du",
        "elle", "elles", "en", "est", "et", "eux", "il", "ils", "je", "l", "la", "le",
        "les", "leur", "lui", "ma", "mais", "me", "mes", "mon", "ne", "nous", "on", "ou",
        "où", "par", "pas", "pour", "qu", "que", "qui", "s", "sa", "se", "ses", "son",
        "sont", "sur", "te", "tes", "toi", "ton", "tu", "un", "une", "vos", "votre",
        "vous", "y",
    ],
    "en": [
        "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "have",
        "he", "her", "his", "i", "in", "is", "it", "its", "my", "not", "of", "on", "or",
        "our", "she", "that", "the", "their", "they", "this", "to", "was", "we", "were",
        "with", "you", "your",
    ],
}
