"""Schemas of the provider documents."""

from __future__ import annotations

_CODE = "struct<value: int, displayName: string>"
_EVENT = f"""struct<eventId: bigint, teamId: bigint, playerId: bigint, relatedPlayerId: bigint, minute: bigint, second: bigint,
  expandedMinute: bigint, x: double, y: double, endX: double, endY: double, isTouch: boolean, isShot: boolean, type: {_CODE},
  outcomeType: {_CODE}, period: {_CODE}, qualifiers: array<struct<type: {_CODE}, value: string>>>"""
_EV_SIDE = """struct<teamId: bigint, name: string,
  players: array<struct<playerId: bigint, name: string, shirtNo: bigint, position: string, isFirstEleven: boolean, isManOfTheMatch: boolean,
    age: bigint, height: bigint, weight: bigint, subbedInExpandedMinute: bigint, subbedInPlayerId: bigint,
    subbedOutExpandedMinute: bigint, subbedOutPlayerId: bigint>>,
  formations: array<struct<formationName: string, formationId: bigint, startMinuteExpanded: bigint, endMinuteExpanded: bigint,
    captainPlayerId: bigint, subOnPlayerId: bigint, subOffPlayerId: bigint, playerIds: array<bigint>, jerseyNumbers: array<bigint>>>,
  stats: struct<possession: map<string, double>>>"""
EVENT_DOC = f"""struct<code: string, score: string, htScore: string, venueName: string, startTime: string, attendance: bigint,
  referee: struct<name: string>, playerIdNameDictionary: map<string, string>, home: {_EV_SIDE}, away: {_EV_SIDE},
  events: array<{_EVENT}>, _corrupt_record: string>"""

_XG_PLAYER = """array<struct<id: bigint, name: string, shirtNumber: bigint, positionId: int, usualPlayingPositionId: int,
  horizontalLayout: struct<y: double>, isCaptain: boolean, age: bigint, countryName: string, countryCode: string,
  performance: struct<rating: double>, unavailability: struct<type: string, reason: string>>>"""
_XG_SIDE = f"""struct<id: bigint, name: string, formation: string, starters: {_XG_PLAYER}, subs: {_XG_PLAYER}, unavailable: {_XG_PLAYER},
  coach: struct<id: bigint, name: string, countryName: string, countryCode: string, age: bigint>>"""
_COLORS = "struct<home: string, away: string>"
XG_DOC = f"""struct<code: string,
  general: struct<matchName: string, matchRound: string, leagueId: bigint, leagueName: string, leagueRoundName: string,
    teamColors: struct<lightMode: {_COLORS}, darkMode: {_COLORS}, fontLightMode: {_COLORS}, fontDarkMode: {_COLORS}>>,
  header: struct<teams: array<struct<id: bigint, name: string, score: bigint>>>,
  content: struct<
    matchFacts: struct<countryCode: string, infoBox: struct<`Match Date`: struct<utcTime: string>,
        Stadium: struct<name: string, city: string, country: string, capacity: bigint>, Attendance: bigint,
        Referee: struct<text: string, country: string>>,
      playerOfTheMatch: struct<id: bigint, name: struct<fullName: string>, rating: struct<num: double>>>,
    lineup: struct<homeTeam: {_XG_SIDE}, awayTeam: {_XG_SIDE}>,
    playerStats: map<string, struct<id: bigint, name: string, teamId: bigint, teamName: string, isGoalkeeper: boolean, shirtNumber: bigint,
      positionId: int, stats: array<struct<stats: map<string, struct<key: string, title: string, stat: struct<value: string, total: string>>>>>>>,
    stats: struct<Periods: map<string, struct<stats: array<struct<title: string, key: string,
      stats: array<struct<key: string, title: string, type: string, format: string, highlighted: string, stats: array<string>>>>>>>>,
    shotmap: struct<shots: array<struct<id: bigint, eventType: string, teamId: bigint, playerId: bigint, playerName: string, x: double, y: double,
      min: bigint, minAdded: bigint, period: string, isBlocked: boolean, isOnTarget: boolean, isOwnGoal: boolean, isFromInsideBox: boolean,
      isSavedOffLine: boolean, blockedX: double, blockedY: double, goalCrossedY: double, goalCrossedZ: double, expectedGoals: double,
      expectedGoalsOnTarget: double, shotType: string, situation: string, keeperId: bigint, onGoalShot: string>>>,
    momentum: struct<main: struct<data: array<string>>>>,
  _corrupt_record: string>"""

_RD_PERSON = "struct<id: bigint, name: string, country: struct<name: string>, dateOfBirthTimestamp: string>"
_RD_SIDE = f"""struct<formation: string, players: array<struct<player: {_RD_PERSON}, position: string, shirtNumber: bigint, substitute: boolean,
    captain: boolean, statistics: map<string, string>>>,
  missingPlayers: array<struct<player: {_RD_PERSON}, type: string, reason: string, description: string, externalType: string, expectedEndDate: string>>>"""
RD_LINEUPS = f"struct<home: {_RD_SIDE}, away: {_RD_SIDE}, _corrupt_record: string>"
_RD_TEAM = """struct<id: bigint, name: string, country: struct<name: string>, foundationDateTimestamp: string,
  venue: struct<city: struct<name: string>, stadium: struct<name: string, capacity: bigint>, venueCoordinates: struct<latitude: double, longitude: double>>>"""
_RD_SCORE = """struct<current: bigint, display: bigint, period1: bigint, period2: bigint, normaltime: bigint, extra1: bigint, extra2: bigint,
  overtime: bigint, penalties: bigint>"""
RD_EVENT = f"""struct<event: struct<id: bigint, tournament: struct<name: string, competitionType: string, uniqueTournament: struct<id: bigint>,
    category: struct<name: string, country: struct<name: string>>>,
  season: struct<id: bigint, name: string, year: string>, homeTeam: {_RD_TEAM}, awayTeam: {_RD_TEAM}, venue: struct<name: string>,
  referee: struct<id: bigint, name: string, country: struct<name: string>, redCards: bigint, yellowCards: bigint, yellowRedCards: bigint, games: bigint>,
  winnerCode: bigint, startTimestamp: bigint, homeScore: {_RD_SCORE}, awayScore: {_RD_SCORE}, time: struct<currentPeriodStartTimestamp: bigint>>, _corrupt_record: string>"""
_MANAGER = "struct<id: bigint, name: string, shortName: string, slug: string>"
RD_MANAGERS = f"struct<homeManager: {_MANAGER}, awayManager: {_MANAGER}, _corrupt_record: string>"
RD_BEST = "struct<playerOfTheMatch: struct<value: string, player: struct<id: bigint, name: string>>, _corrupt_record: string>"
# Elements and events are read as maps too, so that fields the library does not know are kept.
RD_EVENT_FIELDS = "struct<event: map<string, string>, _corrupt_record: string>"
RD_SHOTS = "struct<shotmap: array<map<string, string>>, _corrupt_record: string>"
RD_STATISTICS = """struct<statistics: array<struct<period: string, groups: array<struct<statisticsItems: array<struct<name: string, homeValue: string, awayValue: string,
  homeTotal: string, awayTotal: string>>>>>>, _corrupt_record: string>"""
RD_ODDS = """struct<eventId: bigint, markets: array<struct<marketPeriod: string, marketGroup: string, choiceGroup: string,
  choices: array<struct<name: string, fractionalValue: string, winning: boolean>>>>, _corrupt_record: string>"""

_PRICE = "map<string, struct<odds_value: double, odds_direction: int, bookie_name: string, bookie_slug: string>>"
ODDS_DOC = f"""struct<message: array<string>, data: struct<market_name: string, market_group_id: bigint, has_handicap: string, outcome_names: array<string>,
  periods: array<struct<id: string, name: string>>,
  odds: map<string, struct<odds: {_PRICE}, alternative: array<struct<name: string, name_en: string, odds: {_PRICE}>>>>>, _corrupt_record: string>"""
ALIAS = "bad_id bigint, canonical_id bigint"
