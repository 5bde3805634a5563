"""Cleaning cases: (name, raw, option overrides or None, expected fields).

An expected value of ``...`` means "not null".
"""

DEFAULT_NINE = {
    "anchorChars": "ACGTU",
    "anchorMinrun": "8",
    "anchorStrict": "ACGTU",
    "gapRegex": r"[-\.]",
    "naturalLanguageRegex": "UNMERGED",
    "iupacRna": "ACGTURYSWKMBDHVN",
    "iupacDna": "ACGTRYSWKMBDHVN",
    "nrunCapFrom": "6",
    "nrunCapTo": "5",
}
RELAXED = {"anchorMinrun": "1"}


def seq(text, **more):
    return {"sequence": text, "sequenceLength": len(text), "invalid": False, **more}


CLEAN = dict(
    naturalLanguageDetected=False, endsTrimmed=False, gapsOrWhitespaceRemoved=False
)

DEFAULT_CASES = [
    ("null", None, None, None),
    (
        "basic",
        "GATTACAGATTACACC",
        None,
        seq(
            "GATTACAGATTACACC",
            **CLEAN,
            seqId=None,
            rawSequence="GATTACAGATTACACC",
            nonIupacFraction=0.0,
            nonACGTNFraction=0.0,
            nFraction=0.0,
            nNrunsCapped=0,
            gcContent=0.375,
            nucleotideSequenceID=...,
        ),
    ),
    ("whitespace", "  ttgac\tcatgg a\r\n", None, seq("TTGACCATGGA", gapsOrWhitespaceRemoved=True)),
    ("gaps", "-CCGATA.-GGTTA--", None, seq("CCGATAGGTTA", gapsOrWhitespaceRemoved=True)),
    ("rna", "GGCAUUCGAUAUC", None, seq("GGCATTCGATATC")),
    ("lower", "ccatggtaaccg", None, seq("CCATGGTAACCG", gapsOrWhitespaceRemoved=False)),
    (
        "nl",
        "unmergedGATTC",
        None,
        dict(
            naturalLanguageDetected=True,
            invalid=True,
            sequence=None,
            sequenceLength=0,
            endsTrimmed=True,
        ),
    ),
    (
        "ncap",
        "TTGACCATNNNNNNNNGGATCCAA",
        None,
        seq("TTGACCATNNNNNGGATCCAA", nNrunsCapped=1),
    ),
    ("gc", "CGTATTAACATTTAAT", None, seq("CGTATTAACATTTAAT", gcContent=0.1875)),
    (
        "noniupac",
        "CCATGGTTAZCCQGGATTACA",
        None,
        dict(
            nonIupacFraction=2 / 21,
            invalid=True,
            sequence=None,
            nucleotideSequenceID=None,
            sequenceLength=21,
        ),
    ),
    (
        "empty",
        "",
        None,
        seq(
            "",
            **CLEAN,
            rawSequence="",
            nonIupacFraction=None,
            nonACGTNFraction=None,
            nFraction=None,
            gcContent=None,
            nucleotideSequenceID=None,
            nNrunsCapped=0,
        ),
    ),
    (
        "question",
        "GATTACAGT??CCATGGAT",
        None,
        seq("GATTACAGTNNCCATGGAT", nFraction=2 / 19),
    ),
    (
        "wiped",
        "LOREMIPSUMDOLOR",
        None,
        seq("", endsTrimmed=True, nucleotideSequenceID=None),
    ),
    (
        "trimboth",
        "FORWARDPRIMERXTTGACCATGACATQQNNNNREVERSE",
        None,
        seq("TTGACCATGACAT", endsTrimmed=True),
    ),
    (
        "ncap2",
        "CATGCATGNNNNNNNTTGACCATNNNNNNNNNNNNGGATCCAA",
        None,
        seq("CATGCATGNNNNNTTGACCATNNNNNGGATCCAA", nNrunsCapped=2),
    ),
    ("nl_space", "ACGTACGTUN MERGED", None, dict(naturalLanguageDetected=True, invalid=True)),
    (
        "nl_dash",
        "ACGTACGTUN-MERGED",
        None,
        dict(naturalLanguageDetected=False, gapsOrWhitespaceRemoved=True),
    ),
    (
        "vtab",
        "ACGTACGT\x0bACGTACGT",
        None,
        seq("ACGTACGTACGTACGT", gapsOrWhitespaceRemoved=True),
    ),
    (
        "nbsp",
        "ACGTACGT ACGTACGT",
        None,
        dict(gapsOrWhitespaceRemoved=False, invalid=True, sequenceLength=17),
    ),
    (
        "astral",
        "ACGTACGT\U0001f600ACGTACGT",
        None,
        dict(sequenceLength=18, nonIupacFraction=1 / 18, nonACGTNFraction=1 / 18, invalid=True),
    ),
    (
        "ambig",
        "ACGTACGTRYACGTACGT",
        None,
        seq("ACGTACGTRYACGTACGT", nonACGTNFraction=2 / 18, nonIupacFraction=0.0, gcContent=0.5),
    ),
    # Upper-casing may lengthen a text, and S is an alphabet letter.
    ("sharp_s", "ACGTACGTßACGTACGT", None, seq("ACGTACGTSSACGTACGT")),
    # Line breaks that the whitespace stage keeps do not end the trimmed span.
    (
        "line_separator",
        "xACGTACGT \u0085ACGTACGTx",
        None,
        dict(sequenceLength=18, endsTrimmed=True, invalid=True, nonIupacFraction=2 / 18),
    ),
    ("short_runs", "ACGTACGXACGTACG", None, seq("", endsTrimmed=True)),
    ("one_run_tail", "XACGTACGTNACGTACG", None, seq("ACGTACGT", endsTrimmed=True)),
    ("n_ends", "NNNNNNNACGTACGTNNNNNNN", None, seq("ACGTACGT", endsTrimmed=True, nNrunsCapped=0)),
    ("gap_in_run", "ACGT-ACG-T", None, seq("ACGTACGT", gapsOrWhitespaceRemoved=True)),
    ("n_by_gap", "ACGTACGTNNN-NNNACGTACGT", None, seq("ACGTACGTNNNNNACGTACGT", nNrunsCapped=1)),
    ("n_by_question", "ACGTACGTNNN???ACGTACGT", None, seq("ACGTACGTNNNNNACGTACGT", nNrunsCapped=1)),
    ("five_n", "ACGTACGTNNNNNACGTACGT", None, seq("ACGTACGTNNNNNACGTACGT", nNrunsCapped=0)),
    ("only_blanks", " \t\n", None, seq("", gapsOrWhitespaceRemoved=True, endsTrimmed=False)),
    ("only_gaps", "-.-", None, seq("", gapsOrWhitespaceRemoved=True, endsTrimmed=False)),
]

OPTION_CASES = [
    (
        "low_cap",
        "CATTGCAGCNNNNNTTAGACCA",
        {"nrunCapFrom": "4", "nrunCapTo": "1"},
        seq("CATTGCAGCNTTAGACCA", nNrunsCapped=1),
    ),
    (
        "anchors",
        "ccTTAGGAcTTGAGctt",
        {"anchorChars": "AG", "anchorMinrun": "3"},
        seq("AGGACTTGAG", endsTrimmed=True),
    ),
    (
        "gap_class",
        "CC~ATGG*TAAC~~CG",
        {"gapRegex": "[~*]"},
        seq("CCATGGTAACCG", gapsOrWhitespaceRemoved=True),
    ),
    ("all_nine", "ttga.ccat", DEFAULT_NINE, seq("TTGACCAT")),
    ("relaxed_ws", "tt\tga ccat\ngg", RELAXED, seq("TTGACCATGG")),
    (
        "relaxed_gaps",
        "TTG-A.-CCAT",
        RELAXED,
        seq("TTGACCAT", gapsOrWhitespaceRemoved=True),
    ),
    ("relaxed_rna", "UUGAC?CAU", RELAXED, seq("TTGACNCAT")),
    ("relaxed_cap", "TTGANNNNNNNNCCAT", RELAXED, seq("TTGANNNNNCCAT", nNrunsCapped=1)),
    (
        "relaxed_id",
        "TTGACCATGGATCCAA",
        RELAXED,
        # MD5 of the cleaned text, from the md5sum tool.
        seq("TTGACCATGGATCCAA", nucleotideSequenceID="dd0929804086b0546ee7baaee6e3bc57"),
    ),
    (
        "bad_ints",
        "ACGTACGTNNNNNNNACGTACGT",
        {"nrunCapFrom": "abc", "nrunCapTo": ""},
        seq("ACGTACGTNNNNNACGTACGT", nNrunsCapped=1),
    ),
    (
        "blank_int",
        "ACGTACGTNNNNNNNACGTACGT",
        {"nrunCapFrom": " 10"},
        seq("ACGTACGTNNNNNACGTACGT", nNrunsCapped=1),
    ),
    (
        "newline_int",
        "ACGTACGTNNNNNNNACGTACGT",
        {"nrunCapFrom": "10\n"},
        seq("ACGTACGTNNNNNACGTACGT", nNrunsCapped=1),
    ),
    (
        "huge_int",
        "ACGTACGTNNNNNNNACGTACGT",
        {"nrunCapFrom": "99999999999"},
        seq("ACGTACGTNNNNNACGTACGT", nNrunsCapped=1),
    ),
    (
        "signed_int",
        "ACGTACGTNNNNNNNACGTACGT",
        {"nrunCapFrom": "+7", "nrunCapTo": "007"},
        seq("ACGTACGTNNNNNNNACGTACGT", nNrunsCapped=1),
    ),
    (
        "no_trim",
        "XXACGTXX",
        {"anchorMinrun": "0"},
        dict(sequence=None, invalid=True, endsTrimmed=False, sequenceLength=8),
    ),
    (
        "unknown_keys",
        "ACGTACGTNNNNNNNACGTACGTX",
        {"maxNRunsCap": "10", "trimEnds": "false"},
        seq("ACGTACGTNNNNNACGTACGT", nNrunsCapped=1, endsTrimmed=True),
    ),
    ("empty_map", "ACGTACGT", {}, seq("ACGTACGT")),
    ("null_value", "ACGTACGT", {"anchorChars": None}, seq("ACGTACGT")),
    ("cap_to_zero", "ACGTACGTNNNNNNNACGTACGT", {"nrunCapTo": "0"}, seq("ACGTACGTACGTACGT")),
    (
        "cap_longer",
        "TTAGGCATNNGGCATTAC",
        {"nrunCapFrom": "2", "nrunCapTo": "4"},
        seq("TTAGGCATNNNNGGCATTAC", nNrunsCapped=1),
    ),
    # A pattern that matches nothing everywhere: it inserts, and an empty text counts none.
    (
        "cap_from_zero_empty",
        "",
        {"nrunCapFrom": "0", "nrunCapTo": "2"},
        seq("NN", nNrunsCapped=0, nFraction=1.0),
    ),
    ("cap_from_zero", "AC", {"nrunCapFrom": "0", "nrunCapTo": "1", **RELAXED}, seq("NANCN", nNrunsCapped=3)),
    # The gap pattern may match without removing anything.
    ("empty_gap_match", "ACGTACGT", {"gapRegex": "-*"}, seq("ACGTACGT", gapsOrWhitespaceRemoved=True)),
    ("long_gap", "ACGTGAPACGT", {"gapRegex": "GAP"}, seq("ACGTACGT", gapsOrWhitespaceRemoved=True)),
    ("class_range", "12ABCDEFGHIJ12", {"anchorChars": "A-J", "iupacDna": "A-Z"}, seq("ABCDEFGHIJ", endsTrimmed=True)),
    (
        "class_negated",
        "12ACGTACGTRR12",
        {"anchorChars": "^0-9"},
        seq("ACGTACGTRR", endsTrimmed=True),
    ),
    (
        "language_regex",
        "ACGTACGTFOO7",
        {"naturalLanguageRegex": r"FO+\d"},
        dict(naturalLanguageDetected=True, invalid=True, sequence=None),
    ),
    ("language_lower", "ACGTACGTfoo", {"naturalLanguageRegex": "foo"}, seq("ACGTACGT", naturalLanguageDetected=False)),
    (
        "short_alphabet",
        "ACGTACGTNACGTACGT",
        {"iupacDna": "ACGT"},
        dict(invalid=True, nonIupacFraction=1 / 17, nonACGTNFraction=0.0, nFraction=1 / 17),
    ),
    (
        "wide_alphabet",
        "ACGTACGTXACGTACGT",
        {"iupacDna": "ACGTNX"},
        seq("ACGTACGTXACGTACGT", nonIupacFraction=0.0, nonACGTNFraction=1 / 17),
    ),
]
