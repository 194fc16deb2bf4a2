"""Word lists, lookup tables and patterns that results depend on. All in natural order."""

ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&quot;", '"')]
MARKUP = r"(?i)</?[a-z][^>]{0,40}>"
#: Sub- and superscripts, one to one.
SCRIPTS = ("₀₁₂₃₄₅₆₇₈₉⁰¹²³⁴⁵⁶⁷⁸⁹ₐₑₕᵢₙₒₚₛₜⁿᵃᵇ", "01234567890123456789aehinopstnab")
GREEK = [
    ("α", "alpha"), ("β", "beta"), ("γ", "gamma"), ("δ", "delta"), ("ε", "epsilon"), ("ζ", "zeta"), ("η", "eta"), ("θ", "theta"), ("κ", "kappa"), ("λ", "lambda"),
    ("μ", "mu"), ("ν", "nu"), ("π", "pi"), ("ρ", "rho"), ("σ", "sigma"), ("τ", "tau"), ("φ", "phi"), ("χ", "chi"), ("ψ", "psi"), ("ω", "omega"),
]

# Specificity of a label key.
FRAMEWORKS = "cofs? mofs? zifs? pofs? cmps? ctfs? pafs? hofs? cops? imps? pims? sbas? zsms?".split()
COUNTERS = "sample compound complex material polymer catalyst product entry no".split()
GENERIC = (
    "cof cofs mof mofs zif zifs pof pofs cmp cmps ctf ctfs paf pafs hof hofs cop cops framework frameworks polymer polymers resin sample samples specimen blank control reference "
    "standard pristine product material materials compound compounds complex powder solid crystal crystals bulk film films membrane membranes composite composites catalyst catalysts "
    "support precursor monomer ligand adsorbent asprepared assynthesized assynthesised asmade titlecomplex titlecompound thiswork ourcof experimental simulated calculated observed"
).split()
ADJECTIVES = (
    "imine imino amide amido amine amino azine azo hydrazone boronate boroxine borate ketoenamine enamine olefin vinylene triazine covalent crystalline amorphous porous pure raw neat "
    "blank parent pristine bare fresh used spent recovered recycled regenerated activated calcined hydrated dried wet dry thin thick nano micro meso macro hollow solid magnetic modified "
    "functionalized functionalised doped loaded supported ref reference control standard new old synthesized synthesised prepared obtained target initial final"
).split()
FORMS = "film films membrane membranes powder composite bulk sample nanosheets? nanoparticles? ns np nps".split()
SHORTEST_KEY = 3

# Keywords of a diffraction caption and their weights, for and against.
KEYWORDS = [("pxrd", 1.0), ("powder x-ray diffraction", 1.0), ("powder x ray diffraction", 1.0), ("xrd", 0.7), ("xrpd", 1.0), ("diffractogram", 0.6), ("2theta", 0.5), ("2 theta", 0.5), ("2θ", 0.5), ("bragg", 0.3)]
KEYWORDS_AGAINST = [("nmr", -0.8), ("uv-vis", -0.7), ("uv vis", -0.7), ("ftir", -0.7), ("sem", -0.8), ("tem", -0.8), ("xps", -0.6), ("raman", -0.7)]

# Misread characters of a scanned number: one to one, and those that go.
MISREAD = ("OoIlSB,−–—·|", "001158.---.1")
MISREAD_GONE = "°º"
AXIS_WORDS = [("θ", " theta "), ("ϑ", " theta "), ("Θ", " theta "), ("°", " degree "), ("º", " degree ")]

# Lifecycle of a work by the kind of an update, and how severe each state is.
UPDATES = [
    ("retraction", "retracted"), ("partial_retraction", "concern"), ("withdrawal", "withdrawn"), ("removal", "withdrawn"), ("expression_of_concern", "concern"), ("correction", "corrected"),
    ("erratum", "corrected"), ("corrigendum", "corrected"), ("addendum", "corrected"), ("clarification", "corrected"), ("new_version", "corrected"), ("new_edition", "corrected"),
]
SEVERITY = [("retracted", 4), ("withdrawn", 3), ("concern", 2), ("corrected", 1), ("active", 0)]
TITLE_STAMP = r"(?i)^\s*(RETRACTED\s+ARTICLE|RETRACTED|WITHDRAWN)\s*[:：]\s*"
NOTICE_TITLE = r"(?i)^\s*(Retraction\s+(of|Note|Notice)|Retraction\s*[:：]|Correction\s+to|Correction\s*[:：]|Corrigendum|Erratum|Addendum|Author\s+Correction|Publisher\s+Correction|(Editorial\s+)?Expression\s+of\s+Concern)\b"

# Admission: (class, reason) of a curve to its published class.
ADMISSION = [
    (("clean", None), "clean"), (("axis_verified", None), "axis_verified"), (("excluded", "own_shape_flag"), "shape_flagged"), (("excluded", "axis_single_method"), "axis_unconfirmed"),
    (("excluded", "axis_arbitrated"), "axis_unconfirmed"), (("excluded", "axis_contradicted"), "axis_unconfirmed"), (("excluded", "model_derived"), "model_derived"),
]
VERIFICATION = [("consensus", "axis_cross_validated"), ("single_method", "axis_single_method"), ("arbitrated", "axis_arbitrated")]

# Computed curves: marks in a state, whole states, marks in a label.
COMPUTED_STATE = "simulat calculat pawley pawly rietveld refine difference residual theoret theory predicted modeled model-derived dft-derived stacking eclipsed staggered".split()
COMPUTED_WHOLE = "sim calc calcd diff ycal obs-calc".split()
COMPUTED_LABEL = "simulat (sim -sim calculat pawley rietveld refined difference ycal stacking eclipsed staggered".split()

ROLES = "experimental simulated refined difference reference unclassified".split()
EXPERIMENTAL_STATES = ["experimental", "experiment", "exp", "observed", "measured", "experimental/observed", "experimentally observed"]
ROLE_MARKS = [("simulated", ["simulated", "simulation", "calculated"]), ("refined", ["pawley", "rietveld", "refined"]), ("difference", ["difference"]), ("reference", ["reference", "jcpds"])]

#: Broken encodings: a lead byte read as Latin-1, then a continuation byte read so too.
MOJIBAKE = "[\u00c3\u00c2\u00e2][\u0080-\u00ff\u0152-\u0178\u02c6\u02dc\u2013\u2014\u2018-\u201e\u20ac\u2122\u2039\u203a]|\ufffd"
TREATED = "(?i)soak|hcl|naoh|koh|h2so4|boil|treat|day|calcin|after"
IDENTIFIER = "^[A-Za-z0-9._()-]{1,80}$"
DOI_IN_NAME = r"(?i)(10\.[0-9]{4,9}[_./][^/\s]+)"

# Stored objects: suffixes and words of file names.
IMAGE_SUFFIXES = "png webp jpg jpeg gif tif tiff bmp svg avif".split()
DATA_SUFFIXES = "csv json parquet txt".split()
PUBLISHER_WORDS = "source crop overlay montage".split()
OWN_STEMS = "digitized replot_qa".split()
PLACEHOLDER = ".emptyFolderPlaceholder"

# Application classes and the marks of each, in order.
APPLICATIONS = [
    ("photocatalysis", ["photocat", "h2 evolution", "hydrogen evolution", "h2o2", "water splitting", "co2 photoreduction", "photoreduction", "solar", "photodegrad", "photocataly"]),
    ("gas_adsorption", ["co2 capture", "gas separation", "gas storage", "h2 storage", "ch4", "iodine", "adsorption", "uptake", "capture", "storage"]),
    ("catalysis", ["cataly", "suzuki", "orr", "oer", "her", "co2 reduction", "oxidation", "hydrogenation", "coupling", "electrocataly"]),
    ("water_membrane", ["pfas", "dye", "nanofiltration", "water purification", "water treatment", "membrane", "desalination", "removal", "extraction", "separation"]),
    ("sensing", ["sens", "fluorescen", "sers", "voc", "photonic", "detect", "luminescen", "probe"]),
    ("energy_storage", ["supercapacitor", "battery", "li-s", "electrode", "lithium", "sodium", "zinc", "anode", "cathode"]),
    ("ion_conduction", ["proton conduct", "fuel cell", "ion conduct", "ionic conduct", "ion separation", "conductivity"]),
    ("biomedical", ["drug", "bioimag", "antibacter", "glycoprotein", "biomed", "therapy", "tumor", "antimicrob", "biosens", "cancer"]),
]
HUMP_STATUSES = "hump_detected no_hump_detected window_not_covered not_computed".split()

TITLE_DOI = r"(?i)^(https?://(dx\.)?doi\.org/)?10\.\S+$"
TITLE_PAGE_RANGE = r"\b[0-9]+\s*\.\.\s*[0-9]+\b"
TITLE_BAD = ["microsoft word", "untitled document", "full text pdf", "downloaded from", "elsevier editorial system"]
TITLE_FILES = r"\.(pdf|doc|docx)$"
