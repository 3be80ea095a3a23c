"""Fixed values that results depend on: word lists, lookup tables, constants."""

# Fragments removed from a name, in this order.
NAME_REMOVALS = (".", " II", " III", " IV")

# Opening day of each season.
SEASON_OPENERS = {
    2000: "2000-09-03",
    2001: "2001-09-09",
    2002: "2002-09-05",
    2003: "2003-09-04",
    2004: "2004-09-09",
    2005: "2005-09-08",
    2006: "2006-09-07",
    2007: "2007-09-06",
    2008: "2008-09-04",
    2009: "2009-09-10",
    2010: "2010-09-09",
    2011: "2011-09-08",
    2012: "2012-09-05",
    2013: "2013-09-05",
    2014: "2014-09-04",
    2015: "2015-09-10",
    2016: "2016-09-08",
    2017: "2017-09-07",
    2018: "2018-09-06",
    2019: "2019-09-05",
    2020: "2020-09-10",
    2021: "2021-09-09",
    2022: "2022-09-08",
    2023: "2023-09-07",
    2024: "2024-09-05",
    2025: "2025-09-04",
}

# Rows of each group that count as a team's starters.
STARTER_QUOTAS = {
    "quarterback": 1,
    "o_pass": 3,
    "o_te": 1,
    "o_rush": 1,
    "o_line": 5,
    "d_line": 4,
    "d_lb": 3,
    "d_field": 4,
    "special_teams": 3,
}

# Lower bounds of the rating bands.
RATING_BANDS = ((80, "high"), (60, "mid"))
RATING_BAND_BELOW = "low"

# Attribute columns of the standard layout.
ATTRIBUTES = (
    "agility", "acceleration", "speed", "stamina",
    "strength", "toughness", "injury", "awareness", "jumping", "trucking",
    "archetype", "runningstyle", "changeofdirection", "playrecognition",
    "throwpower", "throwaccuracyshort", "throwaccuracymid", "throwaccuracydeep",
    "playaction", "throwonrun",
    "carrying", "ballcarriervision", "stiffarm", "spinmove", "jukemove",
    "catching", "shortrouterunning", "midrouterunning", "deeprouterunning",
    "spectacularcatch", "catchintraffic", "release",
    "runblocking", "passblocking", "impactblocking",
    "mancoverage", "zonecoverage", "tackle", "hitpower", "press", "pursuit",
    "kickaccuracy", "kickpower", "return",
)

# Generic attributes and the specific ones they stand in for.
GENERIC_ATTRIBUTES = {
    "throwaccuracy": ("throwaccuracyshort", "throwaccuracymid", "throwaccuracydeep"),
    "routerunning": ("shortrouterunning", "midrouterunning", "deeprouterunning"),
}

# Header rules in order. "part" replaces a part of the header,
# "whole" replaces the header when it equals the pattern, "holds" replaces the
# header when it contains the pattern.
HEADER_RULES = (
    ("part", " ", ""),
    ("part", "plyr_", ""),
    ("part", "_", ""),
    ("part", "throwontherun", "throwonrun"),
    ("part", "shortthrowaccuracy", "throwaccuracyshort"),
    ("part", "throwaccshort", "throwaccuracyshort"),
    ("part", "shortaccuracy", "throwaccuracyshort"),
    ("part", "midthrowaccuracy", "throwaccuracymid"),
    ("part", "throwaccmid", "throwaccuracymid"),
    ("part", "throwaccuracymiddle", "throwaccuracymid"),
    ("part", "mediumthrowaccuracy", "throwaccuracymid"),
    ("part", "middleaccuracy", "throwaccuracymid"),
    ("part", "throwaccuracymedium", "throwaccuracymid"),
    ("part", "deepthrowaccuracy", "throwaccuracydeep"),
    ("part", "throwaccdeep", "throwaccuracydeep"),
    ("part", "deepthrowaccruacy", "throwaccuracydeep"),
    ("part", "deepaccuracy", "throwaccuracydeep"),
    ("part", "shortrouteruning", "shortrouterunning"),
    ("part", "shortrr", "shortrouterunning"),
    ("part", "mediumrr", "midrouterunning"),
    ("part", "deeprr", "deeprouterunning"),
    ("part", "speccatch", "spectacularcatch"),
    ("part", "spectactularcatch", "spectacularcatch"),
    ("part", "stength", "strength"),
    ("whole", "overall", "overallrating"),
    ("whole", "ovr", "overallrating"),
    ("whole", "mancover", "mancoverage"),
    ("whole", "zonecover", "zonecoverage"),
    ("whole", "changeofdir", "changeofdirection"),
    ("part", "accleration", "acceleration"),
    ("whole", "runstyle", "runningstyle"),
    ("whole", "handedness", "playerhandedness"),
    ("whole", "playerhandness", "playerhandedness"),
    ("whole", "handed", "playerhandedness"),
    ("holds", "position", "position"),
    ("whole", "pos", "position"),
    ("holds", "jers", "jerseynumber"),
    ("whole", "number", "jerseynumber"),
    ("whole", "impactblock", "impactblocking"),
    ("whole", "runblock", "runblocking"),
    ("whole", "passblock", "passblocking"),
    ("whole", "leadblock", "leadblocking"),
    ("whole", "catch", "catching"),
    ("whole", "name", "fullname"),
    ("whole", "powermove", "powermoves"),
    ("whole", "finnessemoves", "finessemoves"),
    ("whole", "finesseemove", "finessemoves"),
    ("part", "dratfpick", "draftpick"),
    ("part", "bcvision", "ballcarriervision"),
    ("part", "kickreturn", "return"),
    ("whole", "experience", "yearspro"),
    ("whole", "teamname", "team"),
)

# Seasons whose birth dates are packed digits or unreadable.
PACKED_BIRTH_SEASONS = (2018, 2019)
UNREADABLE_BIRTH_SEASONS = (2021, 2023)

# Team labels, aliases first, then codes.
TEAM_ALIASES = {
    "Bucs": "Buccaneers",
    "Team": "Commanders",
    "Redskins": "Commanders",
    "Agents": "FREEAGENT",
    "Agent": "FREEAGENT",
}
TEAM_CODES = {
    "Bears": "CHI", "Bengals": "CIN", "Bills": "BUF", "Broncos": "DEN",
    "Browns": "CLE", "Buccaneers": "TB", "Cardinals": "ARI", "Chargers": "LAC",
    "Chiefs": "KC", "Colts": "IND", "Cowboys": "DAL", "Dolphins": "MIA",
    "Eagles": "PHI", "Falcons": "ATL", "49Ers": "SF", "Giants": "NYG",
    "Jaguars": "JAX", "Jets": "NYJ", "Lions": "DET", "Packers": "GB",
    "Panthers": "CAR", "Patriots": "NE", "Raiders": "LV", "Rams": "LAR",
    "Ravens": "BAL", "Commanders": "WAS", "Saints": "NO", "Seahawks": "SEA",
    "Steelers": "PIT", "Texans": "HOU", "Titans": "TEN", "Vikings": "MIN",
    "Jagaurs": "JAX",
}
TEAM_COUNT = 33

# Corrections applied in this order, as
# (matched column, matched value, changed column, new value).
OVERRIDES = (
    ("fullname", "John Abraham", "position_group", "d_field"),
    ("fullname", "Chike Okeafor", "position_group", "d_field"),
    ("fullname", "Bertrand Berry", "position_group", "d_field"),
    ("fullname", "Fred Wakefield", "position_group", "o_line"),
    ("fullname", "Will Overstreet", "position_group", "d_field"),
    ("fullname", "R-Kal Truluck", "position_group", "d_field"),
    ("fullname", "Eric Ogbogu", "position_group", "d_field"),
    ("fullname", "Adalius Thomas", "position_group", "d_field"),
    ("fullname", "Terrell Suggs", "position_group", "d_field"),
    ("fullname", "Jason Gildon", "position_group", "d_field"),
    ("fullname", "Robert Mathis", "position_group", "d_field"),
    ("fullname", "Shawne Merriman", "position_group", "d_line"),
    ("fullname", "Jason Babin", "position_group", "d_line"),
    ("fullname", "Kenard Lang", "position_group", "d_line"),
    ("fullname", "OJ Atogwe", "position_group", "d_line"),
    ("fullname", "Damane Duckett", "position_group", "d_field"),
    ("fullname", "Brock Lesnar", "position_group", "d_line"),
    ("fullname", "Antwan Peek", "position_group", "d_field"),
    ("fullname", "Dan Klecko", "position_group", "o_rush"),
    ("fullname", "Tamba Hali", "position_group", "d_field"),
    ("fullname", "Mike Sellers", "position_group", "o_pass"),
    ("fullname", "Ben Utecht", "position_group", "o_pass"),
    ("fullname", "Casey Fitzsimmons", "position_group", "o_pass"),
    ("fullname", "Brad Cieslak", "position_group", "o_pass"),
    ("fullname", "Mathias Kiwanuka", "position_group", "d_line"),
    ("fullname", "Quentin Moses", "position_group", "d_field"),
    ("fullname", "Patrick Chukwurah", "position_group", "d_field"),
    ("fullname", "Ikaika Alama-Francis", "position_group", "d_field"),
    ("fullname", "Rob Ninkovich", "position_group", "d_field"),
    ("fullname", "Akbar Gbaja Biamila", "position_group", "d_line"),
    ("fullname", "B.J. Sams", "position_group", "o_rush"),
    ("fullname", "Jim Kleinsasser", "fullname", "Jimmy Kleinsasser"),
    ("fullname", "Jimmy Kleinsasser", "position_group", "o_pass"),
    ("fullname", "Jimmy Kleinsasser", "position", "TE"),
    ("fullname", "Eric Beverly", "position_group", "o_pass"),
    ("fullname", "Michael Moore", "position_group", "o_pass"),
)

# Names replaced after the corrections.
NAME_FIXES = {
    "Justin Madubuike": "Nnamdi Madubuike",
    "R.Webb": "Richmond Webb",
    "Ndukwe Kalu": "ND Kalu",
    "B.Cox": "Byron Cox",
    "H.Ford": "Henry Ford",
    "W.Walls": "Wesley Walls",
    "B.Stai": "Brenden Stai",
    "T.Fair": "Terry Fair",
    "D.Greer": "Donovan Greer",
    "G.Crowell": "Germane Crowell",
    "G.Brown": "Gilbert Brown",
    "T.Mathis": "Terance Mathis",
    "K.Lyle": "Keith Lyle",
    "I.Byrd": "Isaac Byrd",
    "R.Mealey": "Rondell Mealey",
    "A.Dorsett": "Anthony Dorsett",
    "K.Office": "Kendrick Office",
    "C.Peter": "Christian Peter",
    "J.Boyd": "James Boyd",
    "D.Patmon": "DeWayne Patmon",
    "T.Sawyer": "Talance Sawyer",
    "R.Bean": "Robert Bean",
    "M.Fulcher": "Mondriel Fulcher",
    "O.J. Atogwe": "Oshiomogho Atogwe",
    "Michael Jennings": "Mike Jennings",
    "Akbar Gbaja Biamila": "Akbar Gbaja-Biamila",
}

# Identities settled by hand, rating id to player id.
MANUAL_IDENTITIES = {
    "DOMANICKDAVIS_o_rush": "00-0021979",
    "ANTHONYSIMMONS_d_lb": "00-0014889",
    "SAMCOWART_d_lb": "00-0003563",
    "ROCKYCALMUS_d_lb": "00-0021202",
    "RODNEYWILLIAMS_special_teams": "00-0017923",
    "PACMANJONES_19830930": "00-0023441",
    "KENNORTON_d_lb": "00-0034434",
    "RT#79_o_line": "00-0022896",
}

# The passing score per game as (column, factor, divisor).
PASSING_SCORE = (
    ("attempts", -2.2, 1.0),
    ("completions", 3.7, 1.0),
    ("passing_yards", 1.0, 5.0),
    ("passing_tds", 11.3, 1.0),
    ("interceptions", -14.1, 1.0),
    ("sacks", -8.0, 1.0),
    ("carries", -1.1, 1.0),
    ("rushing_yards", 0.6, 1.0),
    ("rushing_tds", 15.9, 1.0),
)

# Components of the passing rating as (numerator, denominator,
# subtracted from the ratio, factor, added), their ceiling and their divisor.
PASSING_RATING = (
    ("completions", "attempts", 0.3, 5.0, 0.0),
    ("passing_yards", "attempts", 3.0, 0.25, 0.0),
    ("passing_tds", "attempts", 0.0, 20.0, 0.0),
    ("interceptions", "attempts", 0.0, -25.0, 2.375),
)
PASSING_RATING_CEILING = 2.375
PASSING_RATING_DIVISOR = 6.0

# Values that stand for a missing draft position.
DRAFT_ROUND_DEFAULT = 8
DRAFT_PICK_DEFAULT = 258

# Columns whose gaps take the mean of the season.
SEASON_MEAN_COLUMNS = (
    "age", "height", "weight", "forty", "bench", "vertical", "broad_jump",
    "cone", "shuttle", "last_season_av",
)

# Style columns, left out of the first two imputation passes.
STYLE_COLUMNS = ("archetype", "runningstyle", "changeofdirection")
