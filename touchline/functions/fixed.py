"""Fixed values the metrics depend on.

Everything here is a plain constant: qualifier ids and names of the event
feed, zone limits, the expected-threat grid, position labels.
"""

# Qualifier name -> qualifier id, as used by the event provider.
QUALIFIER_ID = {
    "Longball": 1,
    "Cross": 2,
    "FreekickTaken": 5,
    "CornerTaken": 6,
    "GoalDisallowed": 8,
    "Penalty": 9,
    "Foul": 13,
    "OtherBodyPart": 21,
    "Assisted": 29,
    "Yellow": 31,
    "Red": 32,
    "SecondYellow": 33,
    "RelatedEventId": 55,
    "MissLeft": 73,
    "MissRight": 75,
    "Blocked": 82,
    "ThrowIn": 107,
    "KeeperThrow": 123,
    "GoalKick": 124,
    "PassEndX": 140,
    "PassEndY": 141,
    "LeadingToAttempt": 169,
    "LeadingToGoal": 170,
    "StandingSave": 178,
    "DivingSave": 179,
    "OverRun": 211,
    "Length": 212,
    "IndirectFreekickTaken": 241,
    "AerialFoul": 264,
    "Defensive": 285,
    "Offensive": 286,
    "KeeperSaveInTheBox": 11115,
    "KeeperSaveObox": 11117,
}

# Event type name -> type id, for the types that are tested by id.
TYPE_ID = {
    "Pass": 1,
    "OffsidePass": 2,
    "TakeOn": 3,
    "Foul": 4,
    "Tackle": 7,
    "Save": 10,
    "MissedShots": 13,
    "ShotOnPost": 14,
    "SavedShot": 15,
    "Goal": 16,
    "Error": 51,
    "BallTouch": 61,
    "BlockedPass": 74,
}

SHOT_TYPE_IDS = [13, 14, 15, 16]
SHOT_TYPES = ["Goal", "SavedShot", "MissedShots", "ShotOnPost"]

# Passes with one of these qualifiers are not base passes: Cross, ThrowIn, KeeperThrow.
NOT_BASE_PASS = [2, 107, 123]
# Dead-ball qualifiers of passes; the state aggregate does not count Penalty (9).
DEAD_BALL_PASS = [5, 6, 9, 107, 123, 124, 241]
DEAD_BALL_STATE = [5, 6, 107, 123, 124, 241]
SET_PIECE_SHOT = ["SetPiece", "FromCorner", "FreekickTaken", "ThrowinSetPiece"]

IN_BOX = [
    "BoxCentre", "BoxLeft", "BoxRight", "SmallBoxCentre", "SmallBoxLeft", "SmallBoxRight",
    "SixYardBlock", "DeepBoxLeft", "DeepBoxRight",
]
OUT_OF_BOX = ["OutOfBoxCentre", "OutOfBoxLeft", "OutOfBoxRight"]
BODY_PARTS = ["RightFoot", "LeftFoot", "Head", "OtherBodyPart"]
PATTERNS = ["RegularPlay", "FromCorner", "SetPiece", "FreekickTaken", "FastBreak", "ThrowinSetPiece"]
TOP_CORNER = ["HighLeft", "HighRight"]
LOW_CORNER = ["LowLeft", "LowRight"]
CENTRE_FRAME = ["LowCentre", "HighCentre"]
MISSED = ["MissHigh", "MissLeft", "MissRight", "MissLow"]

# Shot-creating actions.
SCA_LOOKBACK = 12
SCA_PEEK = 3
SCA_DEAD_PASS = ["ThrowIn", "CornerTaken", "FreekickTaken", "GoalKick", "KickOff", "IndirectFreekickTaken"]
SCA_START = ["BallRecovery", "KeeperPickup", "Save", "Clearance", "BlockedPass"]
SCA_KINDS = ["Pass (Live)", "Pass (Dead)", "Take-On", "Shot", "Fouled", "Interception", "Tackle"]

# Same-team runs leave these administrative events out.
ADMIN_TYPES = ["Start", "End", "FormationSet", "FormationChange", "SubstitutionOn", "SubstitutionOff"]

# Possession sequences.
STOP_TYPES = ["End", "Start", "FormationSet", "FormationChange", "SubstitutionOn", "SubstitutionOff", "OffsideGiven"]
SKIPPED_TYPES = ["CornerAwarded", "Card"]
CONTESTED_TYPES = ["Tackle", "Challenge", "Aerial"]
REFLEX_TYPES = ["Clearance", "BallTouch", "BlockedPass", "Punch"]
NOT_A_SEQUENCE = ["Clearance", "BallTouch", "BlockedPass", "Punch", "Aerial", "Save"]
RESTARTS = ["ThrowIn", "FreekickTaken", "CornerTaken", "GoalKick", "KickOff"]
BALL_WINNING_TYPES = [
    "Tackle", "Challenge", "Interception", "BlockedPass", "BallRecovery", "KeeperPickup", "KeeperSweeper", "Save",
]
SILENT_STOPS = ["End", "SubstitutionOff", "SubstitutionOn", "FormationChange", "FormationSet"]
PRESSING_TYPES = ["Foul", "Tackle", "Interception", "Challenge", "BlockedPass"]
TEN_PLUS = 10
HIGH_TURNOVER_M = 40.0
COUNTER_SECONDS = 10

# Pitch, in metres, and zone limits in feed units (0-100).
PITCH_LENGTH = 105.0
PITCH_WIDTH = 68.0
OWN_THIRD_MAX = 33.3
FINAL_THIRD = 66.6
PRESS_MIN_X = 33.4
KEEPER_BOX_X = 17.0
BOX_X_MIN = 100 - 16.5 / PITCH_LENGTH * 100
BOX_Y_MIN = 50 - (40.32 / PITCH_WIDTH / 2) * 100
BOX_Y_MAX = 50 + (40.32 / PITCH_WIDTH / 2) * 100

# Last regular minute of each period, for stoppage-time labels.
PERIOD_END_MINUTE = {1: 45, 2: 90, 3: 105, 4: 120}

# Expected-threat grid of K. Singh (2018): 12 rows along x, 8 columns along y.
XT_GRID = [
    [0.00638, 0.00349, 0.00634, 0.00938, 0.01093, 0.01073, 0.00634, 0.00316],
    [0.00779, 0.00573, 0.00674, 0.01217, 0.01402, 0.01134, 0.00786, 0.00463],
    [0.00911, 0.00956, 0.01128, 0.01670, 0.02094, 0.01775, 0.01087, 0.00736],
    [0.01117, 0.01035, 0.01914, 0.02845, 0.03339, 0.02955, 0.01840, 0.01028],
    [0.01740, 0.01880, 0.02867, 0.04685, 0.06168, 0.05055, 0.02936, 0.01740],
    [0.01958, 0.02837, 0.05017, 0.09666, 0.14777, 0.10150, 0.05515, 0.02609],
    [0.03229, 0.07104, 0.14790, 0.32686, 0.37779, 0.31918, 0.14052, 0.05785],
    [0.03985, 0.11791, 0.27373, 0.55862, 0.70388, 0.56020, 0.25651, 0.11250],
    [0.04089, 0.15490, 0.35700, 0.73635, 0.88798, 0.68555, 0.34514, 0.12998],
    [0.07092, 0.24042, 0.47735, 0.84972, 0.95987, 0.84515, 0.44834, 0.22405],
    [0.10536, 0.33450, 0.66219, 0.92441, 0.99408, 0.92348, 0.61396, 0.29224],
    [0.19017, 0.50016, 0.80600, 0.97050, 0.99840, 0.95988, 0.68517, 0.37805],
]

# Position ids of the expected-goals provider, grouped by label.
POSITION_LABEL = {
    11: "GK", 32: "RB", 33: "CB", 34: "CB", 35: "CB", 36: "CB", 37: "CB", 38: "LB",
    51: "RWB", 55: "CB", 62: "RWB", 63: "DM", 64: "DM", 65: "DM", 66: "DM", 68: "LWB",
    71: "RM", 72: "RM", 73: "CM", 74: "CM", 75: "CM", 77: "CM", 78: "LM", 79: "LM",
    82: "RW", 83: "RW", 84: "AM", 85: "AM", 86: "AM", 87: "LW", 88: "LW", 95: "AM",
    103: "RW", 104: "ST", 105: "ST", 106: "ST", 107: "LW", 115: "ST",
}
LATERAL_POSITIONS = ["CB", "DM", "CM", "AM", "ST"]
CENTRAL_PREFIX = ["DM", "AM"]
USUAL_POSITION = {0: "GK", 1: "DEF", 2: "MID", 3: "FWD"}

# Market groups kept by the wide odds table.
ODDS_GROUPS = ["1X2", "Double chance", "Both teams to score", "Match goals"]
