"""Word lists, patterns, thresholds and level hierarchies.

Everything in this module is a value the results depend on, stated as text.  Every function that uses one takes it as
a default argument or through a parameter, so another country's lists can be supplied instead.
"""

from __future__ import annotations

# --- fixed values: file extensions ------------------------------------------------------------------------------
DATA_EXTENSIONS = ("csv", "tsv", "xlsx", "xls", "parquet", "json", "geojson", "zip", "shp")
FORMAT_CATEGORY = {
    "xlsx": "structured",
    "xls": "structured",
    "csv": "structured",
    "tsv": "structured",
    "parquet": "structured",
    "geojson": "semi-structured",
    "json": "semi-structured",
    "shp": "semi-structured",
    "zip": "semi-structured",
    "kml": "semi-structured",
    "kmz": "semi-structured",
    "fgb": "semi-structured",
    "gpx": "semi-structured",
}
GEOJSON_TYPES = ("FeatureCollection", "Feature", "Point", "Polygon", "MultiPolygon", "LineString")

# --- fixed values: detector thresholds ---------------------------------------------------------------------------
NUMERIC_RATIO_MIN = 0.80
NONZERO_RATIO_MIN = 0.10
ID_LIKE_RATIO_MIN = 0.90
NOMINAL_RATIO_MAX = 0.20
NOMINAL_DISTINCT_MAX = 50
NOMINAL_DISTINCT_MIN = 2
NOMINAL_AVG_LEN_MAX = 64
BOOLEAN_COVERAGE_MIN = 0.95
LIKERT_NUMERIC_MIN = 0.95
LIKERT_KEYWORD_MIN = 0.60
ADDRESS_SHARE_MIN = 0.15
COORDINATE_SCORE_MIN = 0.7
GUARD_NAME_NUMERIC_MIN = 0.50
GUARD_NUMERIC_MIN = 0.80
GUARD_DECIMALS_MIN = 0.05
GUARD_NUNIQUE_MIN = 0.50
GUARD_RANGE_MIN = 20.0

# --- fixed values: words -----------------------------------------------------------------------------------------
BOOLEAN_WORDS = ("true", "false", "yes", "no", "y", "n", "1", "0", "oui", "non", "vrai", "faux", "t", "f")
LIKERT_KEYWORDS = (
    "strongly agree", "agree", "neutral", "disagree", "strongly disagree",
    "tout a fait d'accord", "plutot d'accord", "ni d'accord ni pas d'accord",
    "plutot pas d'accord", "pas du tout d'accord",
)
COUNTRY_VALUE_TOKENS = ("france", "fr", "fra", "republique_francaise", "republique_france")
COUNTRY_COLUMN_NAMES = ("country", "pays", "nation", "etat", "state", "territoire_national")
COUNTRY_NAME_PARTS = ("country", "pays", "nation")
COUNTRY_NAME_ALIASES = ("france", "fr", "republique francaise", "metropole")
COUNTRY_LABEL = "France"
GEOMETRY_COLUMN_NAMES = ("geometry", "geom", "the_geom")

# --- fixed values: number clean-up -------------------------------------------------------------------------------
CURRENCY_PATTERN = r"(?i)[€$£¥]|(eur|usd|gbp|cny|rmb)"
NON_NUMBER_PATTERN = r"[^0-9\-,\.]"

# --- fixed values: value patterns --------------------------------------------------------------------------------
STREET_PATTERN = (
    r"(?iU)\b(?:street|st\.?|avenue|ave\.?|road|rd\.?|boulevard|blvd\.?|lane|ln\.?|drive|dr\.?|route|rte\.?|rue|av\.?"
    r"|bd|chemin|impasse|all[ée]e|place|square)\b"
)
ZIP_PATTERN = r"(?U)\b\d{4,5}\b"
WKT_PREFIXES = ("SRID=", "POINT", "LINESTRING", "POLYGON", "MULTI", "GEOMETRYCOLLECTION")
FULL_TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:?\d{2})?$"
YEAR_MONTH_PATTERN = r"^\d{4}-\d{2}$"
YEAR_PATTERN = r"^\d{4}$"
YEAR_WEEK_PATTERN = r"^\d{4}-W\d{2}$"
YEAR_QUARTER_PATTERN = r"^\d{4}[-]?Q[1-4]$"
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"

# --- fixed values: period patterns, most specific form first within a granularity; (pattern, {part: group}) -------
PERIOD_PATTERNS = {
    "quarter": (
        (r"(?i)\b((?:18|19|20)\d{2})[\-_ ]?Q([1-4])\b", {"y": 1, "q": 2}),
        (r"(?i)\bQ([1-4])[\-_ ]?((?:18|19|20)\d{2})\b", {"q": 1, "y": 2}),
        (r"(?i)\b((?:18|19|20)\d{2})[\-_ ]?T([1-4])\b", {"y": 1, "q": 2}),
        (r"(?i)\bT([1-4])[\-_ ]?((?:18|19|20)\d{2})\b", {"q": 1, "y": 2}),
    ),
    "semester": (
        (r"(?i)\bS([12])[\-_ ]?((?:18|19|20)\d{2})\b", {"s": 1, "y": 2}),
        (r"(?i)\b((?:18|19|20)\d{2})[\-_ ]?S([12])\b", {"y": 1, "s": 2}),
    ),
    "week": (
        (r"(?i)\b((?:18|19|20)\d{2})[\-_ ]?W([0-5]\d)\b", {"y": 1, "w": 2}),
        (r"(?i)\bW([0-5]\d)[\-_ ]?((?:18|19|20)\d{2})\b", {"w": 1, "y": 2}),
    ),
    "month": (
        (r"\b((?:18|19|20)\d{2})[\-_/ ]?(0?[1-9]|1[0-2])\b", {"y": 1, "m": 2}),
        (r"\b((?:18|19|20)\d{2})(0[1-9]|1[0-2])\b", {"y": 1, "m": 2}),
    ),
    "date": (
        (r"\b((?:18|19|20)\d{2})[\-/_ ]?(0[1-9]|1[0-2])[\-/_ ]?(0[1-9]|[12]\d|3[01])\b", {"y": 1, "m": 2, "d": 3}),
    ),
    "year": (
        (r"\b((?:18|19|20)\d{2})\b", {"y": 1}),
    ),
}
FILE_NAME_GRANULARITIES = ("date", "week", "month", "quarter", "semester", "year")
PERIOD_RANK = {"date": 4, "month": 3, "quarter": 3, "semester": 3, "week": 2, "year": 1}
PERIOD_CONFIDENCE = {"date": 0.98, "month": 0.96, "quarter": 0.95, "semester": 0.95, "week": 0.93, "year": 0.90}

# --- fixed values: column-name words per spatial level, in level order; names are lower case without accents ------
SPATIAL_NAME_WORDS = {
    "reg": (
        "reg", "region", "regional(?:e|es)?", "state", "province", "area",
        r"(?:code|insee|nom|lib(?:elle)?)[_\s\-]*(?:reg(?:ion)?)",
    ),
    "dep": (
        "dep", "dpt", "departement", "departemental(?:e|es)?", "department", "county",
        r"(?:code|insee|nom|lib(?:elle)?)[_\s\-]*(?:dep(?:art(?:ement)?)?)",
    ),
    "arr_dep": (
        "arr(?:ondiss(?:ement)?)?", "arrondissement", "district", "subdistrict",
        r"arr(?:ondiss(?:ement)?)?[_\s\-]*(?:dep|dpt|departement)",
        r"(?:code|insee|nom|lib(?:elle)?)[_\s\-]*arr[_\s\-]*(?:dep|dpt|departement)",
        r"arr[_\s\-]*dep",
    ),
    "canton": (
        "canton", "cantonal(?:e|es)?", "ward", "precinct",
        r"(?:code|insee|nom|lib(?:elle)?)[_\s\-]*canton",
    ),
    "epci": (
        "epci", r"siren[_\s\-]*epci", "intercommunal(?:ity)?", r"metropolitan(?:[_\s\-]*area)?", "federation",
        r"(?:code|insee|nom|lib(?:elle)?)[_\s\-]*epci",
    ),
    "academie": (
        "academie", "aca", "academy", r"school[_\s\-]*district", r"education[_\s\-]*region",
        r"(?:code|insee|nom|lib(?:elle)?)[_\s\-]*(?:aca(?:demie)?)",
    ),
    "com": (
        "com", "commune", "communal(?:e|es)?", "municipality", "town", "village", "city",
        r"(?:code|insee|nom|lib(?:elle)?)[_\s\-]*(?:com(?:mune)?)",
    ),
    "com_arr": (
        "commune", "municipality", "borough", r"city[_\s\-]*district",
        r"arrondiss(?:ement)?[_\s\-]*mun", r"arrondissement[_\s\-]*municipal", r"com[_\s\-]*arr",
        r"(?:code|insee|nom|lib(?:elle)?)[_\s\-]*(?:com(?:mune)?)",
        r"(?:code|insee|nom|lib(?:elle)?)[_\s\-]*com[_\s\-]*arr",
    ),
    "iris": (
        "iris", "neighbou?rhood", "block",
        r"(?:code|insee|nom|lib(?:elle)?)[_\s\-]*iris",
    ),
}
SPATIAL_GENERIC_PATTERN = (
    r"(?i)\b(zone|territoire|secteur|perimetre|unite(?:_?geo)?|codgeo|code_?geo|geo|geog|geographique|spatial)\b"
)
GEO_FORMAT_PATTERNS = {
    "geometry": r"(?i)\b(the_)?geom(?:etry)?\b|\bshape\b|\bgeom_wkt\b|\bgeomjson\b",
    "wkt": r"(?i)\bwkt\b|well[_\- ]?known[_\- ]?text",
    "geojson": r"(?i)\bgeojson\b|\bgeom?_?json\b|\bjson_?geom\b",
    "geohash": r"(?i)\bgeo_?hash\b|\bgeohash\b|\bgh\b",
}
MEASURE_NAME_PATTERNS = {
    "is_rate": r"\b(rate|taux|ratio|pourcentage|pct|percent|percentage|per_100k|per_capita)\b",
    "is_count": r"\b(nb|nbr|count|nombre|qty|quantite|effectif|n_)\b",
    "is_index": r"\b(index|indice|score|note)\b",
    "is_mean": r"\b(mean|moyenne|avg)\b",
    "is_median": r"\b(median|mediane)\b",
}
GUARD_MEASURE_NAME_PATTERN = (
    r"(?i)\b(rate|taux|pct|pourcentage|ratio|score|index|indice|moyenne|avg|median|mediane|"
    r"sum|total|val(eur|or)|value|revenu|income|population|pop|densite|density|surface|surf(?:_?hab)?|area|"
    r"nb|nbr|nombre|count|qty|quantite|pour_mille|per_?100k|per_?capita)\b"
)
GUARD_LABEL_NAME_PATTERN = (
    r"(?i)\b(libelle|label|nom|name|categorie|category|type|genre|sexe|statut|status|"
    r"classe|class|groupe|group|tranche|modalite|moda|description|desc|qtv)\b"
)
COORDINATE_NAME_PATTERNS = {
    "lat": r"(?i)\b(lat|latitude)\b",
    "lon": r"(?i)\b(lon|lng|long|longitude)\b",
    "y": r"(?i)\b(y|y_coord|ycoord|northing|north|n)\b",
    "x": r"(?i)\b(x|x_coord|xcoord|easting|east|e)\b",
}
COORDINATE_RANGES = {"lat": (-90.0, 90.0), "lon": (-180.0, 180.0), "y": (1e5, 1.1e7), "x": (1e5, 2e7)}

# --- fixed values: address sub-column names, in role order --------------------------------------------------------
ADDRESS_ROLE_PATTERNS = {
    "house_number": r"(?i)^(num(?:ero)?(?:_?voie)?|no_?voie|num_?voie|numvoie|n(?:o|um))$",
    "repetition_index": r"(?i)^(indrep|indice(_?de)?_?repet(?:ition)?)$",
    "way_type": (
        r"(?i)^(typ(?:e)?_?voie|type_?rue|typvoie|nature_?voie|nat_?voie|natvoie"
        r"|type(_?de)?_?voie|typevoie|liblib(?:elle)?_?type_?voie|libtypevoie)$"
    ),
    "way_name": (
        r"(?i)^(nom_?voie|libelle_?voie|liblib(?:elle)?_?voie|nomvoie|nom_?rue"
        r"|libelle(_?de)?_?voie|liblib(?:elle)?_?de_?voie|voie_?libelle|nom(_?de)?_?voie)$"
    ),
    "building": r"(?i)^(bat(?:iment)?|batiment|immeu(?:ble)?|immeuble|tour|bloc|bt|bt_?num|bat_?num(?:ero)?)$",
    "entrance": r"(?i)^(entree|ent)$",
    "stair": r"(?i)^(esc(?:alier)?)$",
    "floor": r"(?i)^(etage|niveau|etg|etage_?num)$",
    "corridor": r"(?i)^(couloir|coul)$",
    "unit_number": (
        r"(?i)^(num(app?t|apt|appartement|logt|logement)|app?t|apt|porte|num_?apt|apt_?num|num_?app?t|app?t_?num"
        r"|num_?logt|logt_?num|num_?logement|logement_?num|porte_?num|num_?porte|lot|lot_?num)$"
    ),
    "mailbox": r"(?i)^(numboite|boite(_?lettres)?|bp|cs|boite_?postale|bp_?\d*)$",
    "complement": (
        r"(?i)^(compl(ement)?(_?(adresse|ident|geo))?|lieu(_|-)?dit|residence|resid|quartier"
        r"|compl(?:ement)?(?:_?\d+)?|adresse_?compl(?:ement)?|compl(?:ement)?_?adresse(?:_?\d+)?)$"
    ),
    "address_line": (
        r"(?i)^((adresse|address|addr)(_?\d+)?|(ligne|line)_?\d+|addr(?:ess)?_?line_?\d+|address_?\d+)$"
    ),
    "postal_code": r"(?i)^(cp|code(_|-)?postal|postal(_|-)?code|zip|post_?code|postcode|code_?post(?:al)?|cedex)$",
    "city": r"(?i)^(ville|commune|localite|city|town|arrondissement|arr|arrdt)$",
    "token": (
        r"(?i)^(voie|rue|avenue|av|bd|boulevard|bld|chemin|route|impasse|allee|place|quai|cours"
        r"|square|sq|ruelle|villa|cite|sente|promenade|pl|quartier|lieu(_|-)?dit)$"
    ),
}
ADDRESS_ROLE_ORDER = (
    "house_number", "repetition_index", "way_type", "way_name",
    "building", "entrance", "stair", "floor", "corridor", "unit_number", "mailbox",
    "complement", "address_line",
)
ADDRESS_CITY_ROLES = ("postal_code", "city")
ADDRESS_COLUMN = "__address__"

# --- fixed values: spatial levels ----------------------------------------------------------------------------------
LEVEL_KEYS = ("reg", "academie", "dep", "arr_dep", "epci", "canton", "com", "com_arr", "iris")
LEVEL_NAMES = {
    "reg": "region",
    "academie": "academie",
    "dep": "departement",
    "arr_dep": "arrondissement_departemental",
    "epci": "epci",
    "canton": "canton",
    "com": "commune",
    "com_arr": "arrondissement_communal",
    "iris": "iris",
}
LEVEL_SPECIFICITY = (
    "country", "region", "academie", "departement", "arrondissement_departemental", "epci", "canton", "commune",
    "arrondissement_communal", "iris",
)
FILE_NAME_LEVEL_ALIASES = (
    ("arr_dep", ("arr_dep", "arrondissement_departemental", "arrondissement_dep")),
    ("com_arr", ("com_arr", "arrondissement_communal", "arrondissement_com")),
    ("dep", ("dep", "dpt", "departement", "department")),
    ("reg", ("reg", "region")),
    ("academie", ("academie", "acad")),
    ("epci", ("epci",)),
    ("canton", ("canton",)),
    ("com", ("com", "commune", "insee")),
    ("iris", ("iris",)),
)
TEXT_CODE_PATTERNS = (
    ("region", r"(?i)\b(0?[1-9]|1[0-3]|11|24|27|28|32|44|52|53|75|76|84|93)\b", 1),
    ("academie", r"(?i)\b(0?[1-9]|1\d|2[0-2])\b", 1),
    ("departement", r"(?i)\b(0[1-9]|[1-8][0-9]|9[0-5]|2a|2b|97[1-6])\b", 1),
    ("arr_dep", r"(?i)\b\d{3}\b", 0),
    ("epci", r"(?i)\b\d{9}\b", 0),
    ("canton", r"(?i)\b(?:\d{2}|2a|2b|97[1-6])[0-9]{2}\b", 0),
    ("commune", r"(?i)\b(\d{5}|2a\d{3}|2b\d{3})\b", 1),
    ("com_arr", r"(?i)\b(\d{5}|2a\d{3}|2b\d{3})\d{2}\b", 1),
    ("iris", r"(?i)\b\d{9}\b", 0),
)

# --- fixed values: hierarchies, general to specific; a tuple lists aliases of one level ----------------------------
HIERARCHIES = {
    "spatial": (
        (
            "country", "region", "academie", "departement", "arrondissement_departemental", "canton", "commune",
            "arrondissement_communal", "iris", ("geometry", "wkt_geojson"), "latlon_pair", "address",
        ),
        (
            "country", "epci", "commune", "arrondissement_communal", "iris", ("geometry", "wkt_geojson"),
            "latlon_pair", "address",
        ),
        ("country", "insee_geo"),
    ),
    "temporal": (
        ("year", "quarter", "month", "date"),
        ("year", "week", "date"),
    ),
}

# --- fixed values: sources of levels of label columns --------------------------------------------------------------
LABEL_LEVEL_MIN = 0.8
LABEL_SOURCES = {
    "level": "insee_geo",
    "mixed": "insee_metadata_sidecar_label_mixed_ref_spatial",
    "one": "insee_metadata_sidecar_label_ref_spatial",
    "by": "insee_metadata_sidecar_label_",
    "none": "insee_metadata_sidecar",
}

# --- fixed values: sheet words -------------------------------------------------------------------------------------
SHEET_DICTIONARY_NAMES = (
    "description", "description des", "dictionary", "data dictionary", "metadata", "variables",
    "liste des variables", "dictionnaire", "dictionnaire de donnees", "nomenclature", "lexique", "glossaire",
)
SHEET_DASHBOARD_NAMES = (
    "dashboard", "tableau de bord", "synthese", "resume", "indicateurs cles", "kpi", "overview",
)
SHEET_KEY_TOKENS = (
    "description", "definition", "explication", "details", "modalites", "format", "type", "unite",
)
SHEET_VARIABLE_TOKENS = (
    "variable", "variables", "champ", "field", "column", "colonne", "attribut", "code", "libelle",
)
SHEET_SHORT_HEADER_TOKENS = ("variable", "champ", "field", "column", "colonne", "description", "definition")

# --- fixed values: storage -----------------------------------------------------------------------------------------
RAW_ZONE_ROOT = "raw"
UNCLASSIFIED = "unclassified"
THEME_SEPARATORS = r">|/|\\|→|»"
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB")
SIDECAR_COLUMNS = ("COD_VAR", "LIB_VAR", "COD_MOD", "LIB_MOD")
