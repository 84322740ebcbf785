"""Pattern tables of the series labels.

Fixed values: all words, their order and the confidences decide the labels.
"""

ORIGIN = {"ORIGINAL": ["ORIGINAL"], "DERIVED": ["DERIVED"]}

RECONSTRUCTION = {
    "MPR": ["MPR"],
    "MIP": ["MIP"],
    "LOCALIZER": ["LOCALIZER"],
    "VOLUME": ["VOLUME"],
    "HELICAL": ["HELICAL"],
    "REFORMATTED": ["REFORMATTED"],
    "AVERAGE": ["AVERAGE"],
}

# '3Ph' is never found in upper-case text; it is listed for completeness.
MULTI_PHASE = ["3PHASE", "3PHASIC", "3P", "3PH", "3Ph"]

STUDY_CONTRAST_YES = [
    "WITH", "CONTRAST", "DYNAMIC", "ENHANCED", "+-C", "+C", "+CM", "WOWITH",
    "WITHOUT_WITH", "WW", "WITHWO", "WITH_WITHOUT", "AP+", "ABP+CM", "T-AP+",
    "C+", "+&-C", "AP+&-C",
] + MULTI_PHASE
STUDY_CONTRAST_NO = ["WITHOUT", "WO", "-C", "PLAIN", "NATIVE", "CHEST-CM"]
STUDY_CONTRAST_BOTH = ["WOWITH", "WITHOUT_WITH", "WW"]

SERIES_CONTRAST_YES = [
    "CE", "CONTRAST", "ENHANCED", "POST", "CORONAL C", "COR C", "+C", "+CM",
    "WITH", "ENHANCEMENT",
]
SERIES_CONTRAST_NO = ["PRE", "PLAIN", "NATIVE", "BASELINE", "W/O", "WO", "-C", "WITHOUT"]
ENHANCED_DOSES = ["1.", "2.", "3.", "4.", "5.", "10."]

PHASE = {
    "NON_CONTRAST": [
        "PRE", "PLAIN", "NATIVE", "BASELINE", "W/O", "WO", "-C", "WITHOUT",
        "PREMONITORING", "CHEST WO", "ABD WO", "NECK -", "ABDPLV -", "AP -C",
    ],
    "ARTERIAL": ["ARTERIAL", "ART", "EARLY", "THIN ARTERIAL", "COR ART"],
    "VENOUS": ["VENOUS", "VEN", "VENOUS PHASE", "LUNG.VEIN"],
    "PORTAL": [
        "PORTAL", "PORTOVENOUS", "THIN PORTOVENOUS", "PORTAL AXIAL",
        "COR-PORTAL", "SAG PORTAL", "PORTAL, IDOSE",
    ],
    "DELAY": [
        "DELAY", "DELAYED", "LATE", "DELAY PHASE", "DELAY THIN CUT",
        "DELAY--", "DELAY 3 MIN", "DELAY 7MIN", "DELAY 15 MIN",
        "COR?DELAY", "SAG DELAY", "AX 3M DELAY", "COR 3M DELAY",
    ],
    "EQUILIBRIUM": ["EQUILIBRIUM", "EQUIL"],
}
ENHANCED_PHASES = ["ARTERIAL", "VENOUS", "PORTAL", "DELAY"]

# Regular expressions, searched in upper-case text.
ORIENTATION = {
    "CORONAL": ["COR", "CORONAL", "CORO", "COR-", "COR.", "COR/", "MPR.*COR"],
    "SAGITTAL": ["SAG", "SAGITTAL", "SAG.*", "SAGITTAL.REF", "MPR.*SAG"],
    "AXIAL": ["AXIAL", "BODY.*AXIAL", "AX", "AXIAL.*TRUE"],
}

BODY_PART_NAMES = {
    "ABDOMEN": "ABDOMEN",
    "CHEST": "CHEST",
    "CHEST_TO_PELVIS": "CHEST_ABDOMEN_PELVIS",
    "WHOLEBODY": "CHEST_ABDOMEN_PELVIS",
    "LIVER": "LIVER",
    "HEAD": "HEAD",
    "NECK": "NECK",
}

# Regular expressions, searched in upper-case text.
BODY_PART = {
    "HEAD": ["HEAD", "BRAIN", "SKULL", "CRANIAL"],
    "NECK": ["NECK", "CERVICAL", "COR NECK"],
    "CHEST": [
        "CHEST", "THORAX", "THX", "PULMONARY", "LUNG", "CARDIAC",
        "ROUTINE CHEST", "CHEST NEW", "THORAXROUTIN",
    ],
    "ABDOMEN": [
        "ABDOMEN", "ABD", "ABDOMINAL", "LIVER", "PANCREAS",
        "ABD_MILAD", "ABDOMENROUTINE",
    ],
    "PELVIS": ["PELVIS", "PEL", "PELVIC"],
    "ABDOMEN_PELVIS": [
        "ABD.*PEL", "ABDPEL", "ABDOMEN.*PELVIS", "ABP", "ABDOMENPELVIS",
        "ABD_PEL", "YGHABDPEL", "ABDPLV",
    ],
    "CHEST_ABDOMEN": ["THX.*ABD", "CHEST.*ABDOMEN", "CHE.*ABD", "CHEST&"],
    "CHEST_ABDOMEN_PELVIS": [
        "THX.*ABD.*PEL", "CHEST.*ABDOMEN.*PELVIS", "CH.*ABD.*PLV",
        "THXABDPEL", "NECKTTHXABDPEL",
    ],
    "LIVER": ["LIVER", "HEPATIC"],
    "EXTREMITIES": ["EXTREMITY", "ARM", "LEG", "HAND", "FOOT"],
    "SPINE": ["SPINE", "SPINAL", "VERTEBRA", "LUMBAR", "CERVICAL"],
}

# A label is kept from this confidence on.
KEEP_FROM = 0.7
