"""Fixed values the pipeline must reproduce exactly.

Everything in this module is data, not logic: rename maps, the player-name
correction map, the team spelling dictionary, the season configuration and
the literal strings that classification rules compare against.  They are
written out plainly so they can be checked line by line.
"""

# --- fixed values: player-name corrections (incoming spelling -> stored spelling) ---
PLAYER_NAME_MAP = {
    "GG Jackson": "Gregory Jackson",
    "GG Jackson II": "Gregory Jackson",
    "A.J. Green": "AJ Green",
    "Elijah Harkless": "EJ Harkless",
    "LJ Cryer": "L.J. Cryer",
    "David Jones Garcia": "David Jones-Garcia",
    "A.J. Lawson": "AJ Lawson",
    "P.J. Washington": "PJ Washington",
    "Craig Porter": "Craig Porter Jr.",
    "O.G. Anunoby": "OG Anunoby",
    "Trevon Scott": "Tre Scott",
}

# --- fixed values: team spellings (lower-case, single-spaced) -> abbreviation ---
TEAM_ABBREVIATIONS = {
    "atlanta": "ATL", "atlanta hawks": "ATL",
    "boston": "BOS", "boston celtics": "BOS",
    "brooklyn": "BKN", "brooklyn nets": "BKN",
    "charlotte": "CHA", "charlotte hornets": "CHA",
    "chicago": "CHI", "chicago bulls": "CHI",
    "cleveland": "CLE", "cleveland cavaliers": "CLE",
    "dallas": "DAL", "dallas mavericks": "DAL",
    "denver": "DEN", "denver nuggets": "DEN",
    "detroit": "DET", "detroit pistons": "DET",
    "golden state": "GSW", "golden state warriors": "GSW",
    "houston": "HOU", "houston rockets": "HOU",
    "indiana": "IND", "indiana pacers": "IND",
    "la clippers": "LAC", "los angeles clippers": "LAC", "clippers": "LAC",
    "la lakers": "LAL", "los angeles lakers": "LAL", "lakers": "LAL",
    "memphis": "MEM", "memphis grizzlies": "MEM",
    "miami": "MIA", "miami heat": "MIA",
    "milwaukee": "MIL", "milwaukee bucks": "MIL",
    "minnesota": "MIN", "minnesota timberwolves": "MIN",
    "new orleans": "NOP", "new orleans pelicans": "NOP",
    "new york": "NYK", "new york knicks": "NYK",
    "oklahoma city": "OKC", "oklahoma city thunder": "OKC",
    "orlando": "ORL", "orlando magic": "ORL",
    "philadelphia": "PHI", "philadelphia 76ers": "PHI",
    "phoenix": "PHX", "phoenix suns": "PHX",
    "portland": "POR", "portland trail blazers": "POR",
    "sacramento": "SAC", "sacramento kings": "SAC",
    "san antonio": "SAS", "san antonio spurs": "SAS",
    "toronto": "TOR", "toronto raptors": "TOR",
    "utah": "UTA", "utah jazz": "UTA",
    "washington": "WAS", "washington wizards": "WAS",
}

# --- fixed values: raw team names seeded while no log holds any ---
CANONICAL_TEAMS = (
    "Atlanta", "Boston", "Brooklyn", "Charlotte", "Chicago", "Cleveland", "Dallas", "Denver",
    "Detroit", "Golden State", "Houston", "Indiana", "LA Clippers", "LA Lakers", "Memphis", "Miami",
    "Milwaukee", "Minnesota", "New Orleans", "New York", "Oklahoma City", "Orlando",
    "Philadelphia", "Phoenix", "Portland", "Sacramento", "San Antonio", "Toronto", "Utah", "Washington",
)

# --- fixed values: season configuration for slates ---
SLATE_SEASONS = ("2024-25", "2025-26")
L30_SEASON = "2025-26"
PLAYOFFS_SEASON = "2026"

# --- fixed values: season-segment classification patterns (case-sensitive) ---
REGULAR_PATTERN = "Regular Season|In-Season Tournament"
PLAYOFFS_PATTERN = "Playoffs|Play-In"

# --- fixed values: absence classification ---
COACH_DECISION = "COACH'S DECISION"
ABSENCE_CD = "DNP-CD"
ABSENCE_OTHER = "INJURY/ILLNESS/OTHER"
ABSENCE_SHEET = "DNP-DND-NWT"
ABSENCE_REQUIRED = ("DATE", "GAME_ID", "TEAM", "OPPONENT", "PLAYER_ID", "PLAYER", "STATUS", "REASON")
ABSENCE_COLUMNS = ("DATE", "GAME_ID", "TEAM", "OPPONENT", "PLAYER_ID", "PLAYER", "STATUS", "REASON", "ABSENCE_TYPE")
ABSENCE_RENAMES = {"GAME_DATE": "DATE", "PLAYER_NAME": "PLAYER"}

# --- fixed values: the feeds name their season-segment column "<vendor> DATASET"; whatever the
# vendor prefix, a sanitised header ending in this suffix is the season segment ---
SEGMENT_HEADER_SUFFIX = "_DATASET"

# --- fixed values: DFS feed (header sanitised with hyphens stripped) ---
DFS_DROP = (
    "FANDUEL",
    "YAHOO",
    "FOR_FANDUEL_FULL_ROSTER_CONTESTS",
    "FOR_YAHOO_FULL_SLATE_CONTESTS",
    "FANDUEL1",
    "YAHOO1",
)
DFS_RENAMES = {
    "OWN_TEAM": "TEAM",
    "OPPONENT_TEAM": "OPPONENT",
    "STARTER_YN": "STARTED",
    "VENUE_RHN": "VENUE",
    "USAGE_RATE": "USAGE",
    "DAYS_REST__3SEASON_DEBUT_0_BACKTOBACK": "DAYS_REST",
    "DRAFTKINGS": "DK_POSITION",
    "FOR_DRAFTKINGS_CLASSIC_CONTESTS": "DK_SALARY",
    "DRAFTKINGS1": "DK_POINTS",
}

# --- fixed values: box-score feed (header sanitised with hyphens -> underscore) ---
BOX_RENAMES = {
    "PLAYER__FULL_NAME": "PLAYER",
    "OWN__TEAM": "TEAM",
    "OPPONENT__TEAM": "OPPONENT",
    "VENUE_RHN": "VENUE",
    "STARTER_YN": "STARTED",
    "MIN": "MINUTES",
    "OR": "OREB",
    "DR": "DREB",
    "TOT": "TREB",
    "A": "AST",
    "ST": "STL",
    "TO": "TOV",
    "BL": "BLK",
    "USAGE__RATE_": "USAGE",
}

# --- fixed values: season-averages output (column order, rounding digits, integer columns) ---
AVERAGES_COLUMNS = (
    "SEASON_TYPE", "PLAYER_ID", "PLAYER", "SEASON", "TEAM", "GP", "GS", "SALPG",
    "FPPG", "STDV_FPPG", "DK_POINTS_sum", "MPG", "STDV_MPG", "MINUTES_sum",
    "STDV_FPPM", "USG", "GSFPPG", "STDV_GSFPPG", "GS_DK_POINTS_sum", "GSMPG",
    "STDV_GSMPG", "GS_MINUTES_sum", "STDV_GSFPPM", "L30_DK_POINTS_sum",
    "L30_MINUTES_sum", "FPPM", "GSFPPM", "L30FPPM",
)
AVERAGES_ROUNDING = {
    "SALPG": 0, "FPPG": 2, "STDV_FPPG": 2, "MPG": 1, "STDV_MPG": 2, "FPPM": 2,
    "STDV_FPPM": 2, "USG": 1, "GSFPPG": 2, "STDV_GSFPPG": 2, "GSMPG": 1,
    "STDV_GSMPG": 2, "GSFPPM": 2, "STDV_GSFPPM": 2, "L30FPPM": 2,
}
AVERAGES_INTEGERS = ("PLAYER_ID", "GP", "GS", "SALPG")

# --- fixed values: slate projections ---
SLATE_COLUMNS = ("SEASON", "PLAYER", "TEAM", "GP", "GS", "MPG", "GSMPG", "FPPG", "GSFPPG", "FPPM", "GSFPPM", "STDV")
SLATE_L30_VIEW_COLUMNS = ("SEASON", "PLAYER", "TEAM", "GP", "GS", "MPG", "GSMPG", "FPPG", "GSFPPG", "FPPM", "L30FPPM", "GSFPPM", "STDV")
SLATE_L30_CSV_COLUMNS = SLATE_COLUMNS + ("L30FPPM",)

MATCH_THRESHOLD = 90
SLATE_HEADER_MARKERS = ("Position", "Name + ID")
