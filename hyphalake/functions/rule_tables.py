"""Rule tables of the isolate classifier: (regular expression, label), matched without regard to case."""

# The patterns, labels, weights and orders below must stay as they are for equal results.

WEIGHT_HARD = 3.0
WEIGHT_MEDIUM = 1.5
WEIGHT_OVERRIDE = 10.0

PROV_CLINICAL = (
    (r"\bclinical(?:ly)?\s+isolat(?:e|ed)\b", "clinical isolate"),
    (r"\bclinical\s+(?:laboratory\s+)?sample\b", "clinical sample"),
    (r"\bpatient\b", "patient"),
    (r"\bhospital(?:ized)?\b", "hospital"),
    (r"\bICU\b", "ICU"),
    (r"\bBALF?\b|\bbronchoalveolar\s+lavage\b", "BAL"),
    (r"\bsputum\b", "sputum"),
    (r"\btracheal\b|\bbronchial\b", "respiratory specimen"),
    (r"\blung\s+tissue\b|\bpulmonary\b", "lung tissue"),
    (r"\bcornea\b|\bcontact\s+lens\b|\beye\b", "eye sample"),
    (r"\bsinus\b|\bparanasal\b|\bnasal\b", "sinus/nasal"),
    (r"\bwound\b|\bulcer\b|\bpus\b|\babscess\b", "wound"),
    (r"\bblood\s+(?:culture|sample)\b|\bblood\b", "blood"),
    (r"\burine\b", "urine"),
    (r"\bswab\b|\bbiopsy\b", "clinical specimen"),
    (r"\bear\b(?!\s*of\s*corn)", "ear"),
    (r"\boral\b|\bgingiva\b|\bdental\b", "oral"),
    (r"\bdrain(?:age)?\b|\bperitoneal\b|\babdominal\b", "abdominal"),
    (r"\bhuman\s+fec(?:es|al)\b|\bhu[mn]an\s+feces\b", "human feces"),
    (r"\bfec(?:es|al)\b|\bstool\b", "fecal"),
    (r"\bhomo\s+sapiens\b|\bhuman\b", "human"),
    (r"\bvet(?:erinary)?\s+(?:clinic|hospital|sample)\b", "veterinary clinical"),
    (r"\bdiseased\s+(?:animal|bird|chicken)\b", "diseased animal"),
    (r"\binfected\s+(?:animal|bird|tissue|host)\b", "infected host"),
)

PROV_ENVIRONMENTAL = (
    (r"\bsoil\b", "soil"),
    (r"\bearth\b|\bground\b", "ground"),
    (r"\brhizosphere\b", "rhizosphere"),
    (r"\bcompost\b|\bdecaying\b", "compost"),
    (r"\bpermafrost\b", "permafrost"),
    (r"\bair\b(?!\s*(?:conditioning|filter))", "air"),
    (r"\batmospher(?:e|ic)\b", "atmospheric"),
    (r"\baerosol\b|\bairborne\b", "airborne"),
    (r"\bdust\b", "dust"),
    (r"\bwater\b(?!\s*(?:treatment|plant))", "water"),
    (r"\baquatic\b|\bfreshwater\b|\bmarine\b", "aquatic"),
    (r"\bsediment\b", "sediment"),
    (r"\bplant\s+debris\b|\blitter\b|\bdetritus\b", "plant debris"),
    (r"\bforest\b|\bwoodland\b|\brain[-\s]?forest\b", "forest"),
    (r"\bagricultural\s+(?:soil|field|land)\b", "agricultural field"),
    (r"\bcrop\s+field\b|\bfarm(?:land)?\b", "farmland"),
    (r"\bcashew\s*nuts?\b|\bpeanuts?\b|\bnuts?\b", "nuts"),
    (r"\bfood\b(?!\s*(?:factory|processing|production))", "food"),
    (r"\bendophyte\b|\bepiphyte\b", "endophyte"),
    (r"\binsect\b|\bbee\b|\bhoney\s*bee\b", "insect-associated"),
    (r"\broot\b|\bleaf\b|\bplant\b", "plant"),
    (r"\bindoor\b|\bbuilding\b|\bhouse\b", "indoor/building"),
    (r"\boutdoor\b|\benvironment(?:al)?\b", "outdoor/environmental"),
    (r"\bsurvey\b|\bcollection\b|\bsampling\b", "environmental survey"),
    (r"\bISS\b|\bInternational\s+Space\s+Station\b", "ISS"),
    (r"\bENVO:\d+\b", "ENVO ontology term"),
)

PROV_INDUSTRIAL = (
    (r"\bkoji\b|\bnuru?k\b|\bdaqu\b|\bqu\b|\bmeju\b", "fermentation starter"),
    (r"\bferment(?:ation|er|or)?\s+(?:plant|facility|site)\b", "fermentation facility"),
    (r"\bferment(?:ed|ing)?\s+foods?\b", "fermented food"),
    (r"\bsoy\s*sauce\s+(?:factory|plant|production)\b", "soy sauce production"),
    (r"\bbrew(?:ery|ing)\b|\bwinery\b", "brewery/winery"),
    (r"\bdistillery\b", "distillery"),
    (r"\bsake\b|\bnihonshu\b|\brice\s+wine\b", "sake/rice wine"),
    (r"\bmiso\b|\bdoenjang\b", "miso/fermented soybean paste"),
    (r"\bsoy\s*sauce\b|\bshoyu\b|\bganjang\b", "soy sauce"),
    (r"\bamazake\b|\bshiokoji\b", "fermented rice product"),
    (r"\bvinegar\b.*\bproduction\b|\brice\s+vinegar\b", "vinegar production"),
    (r"\bbaijiu\b|\bhuangjiu\b|\bchinese\s+(?:wine|liquor)\b", "Chinese fermented alcohol"),
    (r"\bmakgeolli\b|\btakju\b|\bkorean\s+rice\s+wine\b", "Korean rice wine"),
    (r"\btempeh\b|\boncom\b", "tempeh/fermented soybean"),
    (r"\bpu[-\s]?er\s+tea\b|\bkombucha\b|\btea\s+fung(?:us|i)\b", "fermented tea"),
    (r"\bfactory\b|\bplant\b(?=.*production)", "factory"),
    (r"\bbioreactor\b|\bfermentor\b|\bfermenter\b", "bioreactor"),
    (r"\bproduction\s+(?:facility|site|plant|line)\b", "production facility"),
    (r"\bindustrial\s+(?:isolate|strain|facility|site)\b", "industrial site"),
    (r"\bcheese\s+(?:factory|production|facility)\b", "cheese production"),
    (r"\bdairy\s+(?:plant|factory|production)\b", "dairy production"),
    (r"\bfood\s+(?:factory|processing|production)\b", "food processing"),
)

PROV_CULTURE = (
    (r"\bATCC\b", "ATCC"),
    (r"\bCBS\b", "CBS"),
    (r"\bNRRL\b", "NRRL"),
    (r"\bNBRC\b", "NBRC"),
    (r"\bJCM\b", "JCM"),
    (r"\bDSM\b|\bDSMZ\b", "DSMZ"),
    (r"\bFGSC\b", "FGSC"),
    (r"\bIMI\b", "IMI"),
    (r"\bfrom\s+culture\b|\bculture\s+collection\b", "culture collection"),
    (r"\btype\s+strain\b", "type strain"),
    (r"\breference\s+(?:strain|isolate)\b", "reference strain"),
    (r"\blab(?:oratory)?\s+(?:strain|stock|isolate)\b", "lab strain"),
    (r"\bmaintained\s+(?:strain|culture)\b", "maintained culture"),
    (r"\bderived\s+from\b.*\bstrain\b", "derived strain"),
    (r"\bparent(?:al)?\s+strain\b", "parental strain"),
    (r"\blab(?:oratory)?\b", "lab"),
)

PHENO_HUMAN_PATHOGEN = (
    (r"\baspergillosis\b", "aspergillosis"),
    (r"\baspergilloma\b", "aspergilloma"),
    (r"\bCAPA\b", "CAPA"),
    (r"\bIPA\b|\binvasive\s+(?:pulmonary\s+)?aspergillosis\b", "invasive aspergillosis"),
    (r"\bhuman[-\s]?pathogen(?:ic)?\b", "human pathogen"),
    (r"\bpathogenic\s+to\s+humans?\b", "pathogenic to humans"),
    (r"\bmajor\s+etiological\s+agent\b", "etiological agent"),
    (r"\bkeratitis\b|\bfungal\s+keratitis\b", "keratitis"),
    (r"\binvasive\s+(?:fungal\s+)?(?:infection|disease)\b", "invasive infection"),
    (r"\bcystic\s+fibrosis\b", "CF-associated"),
    (r"\bNRZ[-\s]?\d+", "NRZ reference (pathogen)"),
    (r"(?:\banti[-\s]?fungal|azole|triazole)\b.*\bresistan\w+\b", "antifungal resistance"),
    (r"\bvirulen(?:t|ce)\b", "virulence"),
    (r"\b(?:known|opportunistic|major|primary|human)\s+pathogen\b", "pathogen (with context)"),
    (r"\bclinical\s+(?:significance|relevance|importance)\b", "clinical significance"),
)

PHENO_ANIMAL_PATHOGEN = (
    (r"\banimal\s+(?:pathogen|disease|infection)\b", "animal pathogen"),
    (r"\bavian\s+aspergillosis\b", "avian aspergillosis"),
    (r"\bvet(?:erinary)?\s+pathogen\b", "veterinary pathogen"),
    (r"\bkakapo\b", "kakapo pathogen"),
    (r"\btick\s+(?:egg|pathogen)\b|\bRhipicephalus\b", "tick pathogen"),
    (r"\bpoultry\s+(?:disease|pathogen)\b", "poultry pathogen"),
    (r"\bzoonotic\b|\bzoonosis\b", "zoonotic"),
    (r"\blivestock\s+(?:disease|pathogen)\b", "livestock pathogen"),
    (r"\bwildlife\s+(?:disease|pathogen)\b", "wildlife pathogen"),
)

PHENO_PLANT_PATHOGEN = (
    (r"\baflatoxin(?:s|ogenic)?\b", "aflatoxin"),
    (r"\bmycotoxin(?:s|ogenic)?\b", "mycotoxin"),
    (r"\bochratoxin\b", "ochratoxin"),
    (r"\bfumonisin\b", "fumonisin"),
    (r"\bcyclopiazonic\s+acid\b", "cyclopiazonic acid"),
    (r"\bplant\s+(?:pathogen|disease)\b", "plant pathogen"),
    (r"\bcrop\s+(?:contamination|disease|pathogen)\b", "crop contamination"),
    (r"\bgrain\s+(?:contamination|spoilage)\b", "grain contamination"),
    (r"\bpost[-\s]?harvest\s+(?:rot|decay|disease)\b", "postharvest disease"),
    (r"\bseed(?:borne)?\s+pathogen\b", "seedborne pathogen"),
    (r"\brot\b.*\b(?:corn|maize|peanut|grain)\b", "crop rot"),
    (r"\bcontaminated\s+(?:grain|corn|maize|peanut|food)\b", "contaminated crop"),
    (r"\btoxigenic\b", "toxigenic"),
    (r"\bcashew\s*nut", "cashew (crop contamination)"),
    (r"\bpeanut", "peanut (crop contamination)"),
    (r"\bpistachio", "pistachio (crop contamination)"),
    (r"\b(?:moldy|mouldy)\s+(?:corn|maize|peanut|nut|grain)", "moldy crop"),
    (r"\bcorn\b(?!\s*(?:field|farm))", "corn (crop contamination)"),
    (r"\bmaize\b(?!\s*(?:field|farm))", "maize (crop contamination)"),
    (r"\btree\s*nut", "tree nut (crop contamination)"),
    (r"\balmond", "almond (crop contamination)"),
    (r"\bwalnut", "walnut (crop contamination)"),
    (r"\bhazelnut", "hazelnut (crop contamination)"),
    (r"\btiger\s*nut", "tiger nut (crop contamination)"),
)

PHENO_INDUSTRIAL_TRAIT = (
    (r"\bcitric\s+acid\b.*\b(?:produc|high|yield)\b", "citric acid producer"),
    (r"\bitaconic\s+acid\b", "itaconic acid"),
    (r"\bgluconic\s+acid\b", "gluconic acid"),
    (r"\bkojic\s+acid\b", "kojic acid"),
    (r"\benzyme\s+(?:produc|hyper[-\s]?produc)\b", "enzyme producer"),
    (r"\b(?:gluco)?amylase\b.*produc\b", "amylase producer"),
    (r"\bcellulase\b.*produc\b", "cellulase producer"),
    (r"\bprotease\b.*produc\b", "protease producer"),
    (r"\blipase\b.*produc\b", "lipase producer"),
    (r"\bfermentation\s+(?:performance|trait|capability)\b", "fermentation trait"),
    (r"\bsake\b|\bshochu\b|\bmiso\b|\bsoy\s*sauce\b", "traditional fermentation"),
    (r"\bindustrial\s+(?:production|biotechnology|strain)\b", "industrial production"),
    (r"\bhigh\s+(?:productivity|yield|production)\b", "high producer"),
    (r"\bGRAS\b", "GRAS status"),
    (r"\bbiocontrol\b|\bAfla[-\s]?(?:Safe|Guard)\b", "biocontrol"),
    (r"\bnon[-\s]?(?:aflatoxigenic|toxigenic)\b", "non-toxigenic (biocontrol)"),
)

PHENO_ENVIRONMENTAL = (
    (r"\benvironmental\s+(?:isolate|strain|sample)\b", "environmental isolate"),
    (r"^environmental$", "environmental (explicit)"),
    (r"\bsoil\s+isolate\b", "soil isolate"),
    (r"\bsaprob(?:e|ic)\b|\bsaprophyt(?:e|ic)\b", "saprophyte"),
    (r"\bbiodiversity\b|\bsurvey\b|\bpopulation\s+study\b", "biodiversity study"),
    (r"\becolog(?:y|ical)\b", "ecological"),
    (r"\bexperimental\s+(?:farm|orchard|field|plot)\b", "experimental farm/orchard"),
    (r"\bagricultural\s+field\b", "agricultural field"),
    (r"\bfield\s+soil\b", "field soil"),
    (r"\bcitrus\s+field\b", "citrus field"),
    (r"\bgrant\s+farm\b|\bwolfskill\b", "research farm"),
)

NEGATION_PATTERNS = (
    (r"\bnon[-\s]?pathogen(?:ic)?\b", "non-pathogenic"),
    (r"\bnon[-\s]?(?:aflatoxigenic|toxigenic|mycotoxigenic)\b", "non-toxigenic"),
    (r"\bavirulent\b", "avirulent"),
    (r"\battenuated\b", "attenuated"),
    (r"\bnot\s+(?:pathogenic|virulent|toxigenic)\b", "not pathogenic"),
)

#: Name, patterns, class; the first that matches wins.
ESTABLISHED_STRAINS = (
    ("Aspergillus niger CBS 513.88", (r"\bCBS\s*513\.?88\b", r"\bFGSC\s*A1513\b", r"\bASM285v2\b",), "Industrial"),
    ("Aspergillus niger ATCC 1015", (r"\bATCC\s*1015(?:\b|[D-])", r"\bUSDA\s*3528\.7\b", r"\bFGSC\s*A1144\b",), "Industrial"),
    ("Aspergillus terreus ATCC 20542", (r"\bATCC\s*20542\b",), "Industrial"),
    ("Aspergillus oryzae RIB40", (r"\brib[-\s]?40\b", r"\bNBRC\s*100959\b", r"\bATCC\s*42149\b",), "Industrial"),
    ("Aspergillus flavus NRRL 21882", (r"\bNRRL\s*21882\b", r"\bAfla[-\s]?Guard\b",), "Environmental"),
    ("Aspergillus flavus AF36", (r"\bAF[-\s]?36\b", r"\bNRRL\s*18543\b",), "Environmental"),
    ("Aspergillus fumigatus Af293", (r"\bAf\s*293\b|\bAf293\b", r"\bATCC\s*MYA[-\s]?4609\b", r"\bCBS\s*101355\b",), "Human"),
    ("Aspergillus fumigatus A1163", (r"\bA1163\b", r"\bCEA\s*10\b", r"\bCBS\s*144\.?89\b",), "Human"),
    ("Aspergillus fumigatus CEA17", (r"\bCEA[-\s]?17\b",), "Human"),
    ("Aspergillus flavus NRRL 3357", (r"\bNRRL\s*3357\b",), "Plant"),
    ("Aspergillus flavus CA14", (r"\bCA[-\s]?14\b", r"\bKuPG",), "Plant"),
    ("Aspergillus flavus AF13", (r"\bAF[-\s]?13\b",), "Plant"),
    ("Aspergillus flavus ATCC 22546", (r"\bATCC\s*22546\b",), "Plant"),
    ("Aspergillus niger N402", (r"\baspergillus\s+niger\b.*\bN402\b", r"\bATCC\s*64974\b",), "Industrial"),
    ("Aspergillus nidulans FGSC A4", (r"\bFGSC\s*A4\b", r"\baspergillus\s+nidulans\b.*\bA4\b",), "Environmental"),
    ("Aspergillus fumigatus A1160", (r"\bA1160\b",), "Human"),
    ("Aspergillus fumigatus IP_23", (r"\bIP[-_\s]?23\b",), "Human"),
    ("Aspergillus fumigatus IP_24", (r"\bIP[-_\s]?24\b",), "Human"),
    ("Aspergillus fumigatus XC6", (r"\bXC[-\s]?6\b",), "Environmental"),
    ("Aspergillus niger ATCC 10864", (r"\bATCC\s*10864\b",), "Environmental"),
    ("Aspergillus niger CBS 554.65", (r"\bCBS\s*554\.?65\b",), "Industrial"),
    ("Aspergillus niger CBS 113.50", (r"\bCBS\s*113\.?50\b",), "Environmental"),
    ("Aspergillus niger CBS 147323", (r"\bCBS\s*147323\b",), "Plant"),
    ("Aspergillus niger IFM 59636", (r"\bIFM\s*59636\b",), "Human"),
    ("Aspergillus niger CCTCC 206047", (r"\bCCTCC\s*206047\b",), "Industrial"),
    ("Aspergillus oryzae RIB326", (r"\bRIB[-\s]?326\b",), "Industrial"),
    ("Aspergillus oryzae TK-13", (r"\bTK[-\s]?13\b",), "Industrial"),
    ("Aspergillus oryzae TK-17", (r"\bTK[-\s]?17\b",), "Industrial"),
    ("Aspergillus oryzae TK-18", (r"\bTK[-\s]?18\b",), "Industrial"),
    ("Aspergillus oryzae TK-21", (r"\bTK[-\s]?21\b",), "Industrial"),
    ("Aspergillus oryzae TK-27", (r"\bTK[-\s]?27\b",), "Industrial"),
    ("Aspergillus oryzae TK-29", (r"\bTK[-\s]?29\b",), "Industrial"),
    ("Aspergillus oryzae CBS 466.91", (r"\bCBS\s*466\.?91\b",), "Industrial"),
)

#: Kingdom and the key words that name it; the first that occurs wins.
KINGDOMS = (
    ("Aspergillus (self)", ("aspergillus",)),
    ("Other fungi", ("penicillium", "fusarium", "candida", "saccharomyces", "cryptococcus", "neurospora", "magnaporthe", "colletotrichum", "botrytis", "trichoderma", "sphaerospora", "sordariomycetes", "pezizomycotina", "rhizopus", "phaeoacremonium", "mucor", "schizosaccharomyces", "agaricomycetes", "metarhizium", "beauveria", "mycena", "fungus", "fungi")),
    ("Bacteria", ("bacterium", "bacteroidota", "escherichia", "bacillus", "pseudomonas", "staphylococcus", "streptomyces", "mycobacterium", "salmonella", "lactobacillus", "clostridium", "rhizobium", "sphingomonas", "stenotrophomonas", "firmicutes", "proteobacteria", "actinobacteria", "cyanobacteria", "thermodesulfobacteriota")),
    ("Protist", ("perkinsus", "plasmodium", "toxoplasma", "trypanosoma", "leishmania", "tetrahymena", "paramecium", "phytophthora", "amoeba", "dictyostelium", "naegleria", "giardia", "protist", "protozoa")),
    ("Plant", ("arabidopsis", "oryza sativa", "plant", "viridiplantae", "algae")),
    ("Animal", ("drosophila", "mouse", "human", "homo sapiens", "caenorhabditis", "rhipicephalus", "penaeus", "metazoa", "animal", "mammal")),
    ("Virus", ("virus", "viridae")),
)
