"""The shape of a match document."""

_extras = "struct<wides:int,noballs:int,byes:int,legbyes:int,penalty:int>"
_wickets = "array<struct<player_out:string,kind:string,fielders:array<struct<name:string,substitute:boolean>>>>"
_replacements = "struct<match:array<struct<team:string,`in`:string,`out`:string,reason:string>>,role:array<struct<`in`:string,`out`:string,reason:string,role:string>>>"
_ball = f"struct<batter:string,bowler:string,non_striker:string,runs:struct<batter:int,extras:int,total:int,non_boundary:int>,extras:{_extras},wickets:{_wickets},replacements:{_replacements}>"
_overs = f"overs:array<struct<over:int,deliveries:array<{_ball}>>>,"
_innings = (
    f"struct<team:string,{_overs}absent_hurt:array<string>,penalty_runs:struct<pre:int,post:int>,"
    "declared:boolean,forfeited:boolean,target:struct<overs:double,runs:int>,super_over:boolean,powerplays:array<struct<`from`:double,`to`:double,type:string>>>"
)
_outcome = "struct<by:struct<innings:int,runs:int,wickets:int>,winner:string,result:string,method:string,eliminator:string,bowl_out:string>"
_info = (
    "struct<balls_per_over:int,city:string,dates:array<string>,event:struct<name:string,match_number:string,`group`:string,stage:string,sub_name:string>,"
    "gender:string,match_type:string,match_type_number:int,missing:array<string>,"
    "officials:struct<match_referees:array<string>,reserve_umpires:array<string>,tv_umpires:array<string>,umpires:array<string>>,"
    f"outcome:{_outcome},overs:int,player_of_match:array<string>,players:map<string,array<string>>,registry:struct<people:map<string,string>>,season:string,"
    "supersubs:map<string,string>,teams:array<string>,team_type:string,toss:struct<decision:string,winner:string,uncontested:boolean>,venue:string>"
)
MATCH_DDL = f"struct<meta:struct<data_version:string,created:string,revision:int>,info:{_info},innings:array<{_innings}>>"
#: All but the balls: what tables by match or innings need.
INFO_DDL = f"struct<meta:struct<data_version:string,created:string,revision:int>,info:{_info},innings:array<{_innings.replace(_overs, '')}>>"
#: What tables by ball need.
BALLS_DDL = f"struct<info:struct<teams:array<string>>,innings:array<struct<team:string,{_overs.rstrip(',')}>>>"
#: What the elevens at each ball need.
LINEUP_DDL = f"struct<info:struct<players:map<string,array<string>>,teams:array<string>>,innings:array<struct<team:string,overs:array<struct<over:int,deliveries:array<struct<batter:string,bowler:string,non_striker:string,replacements:{_replacements}>>>>>>>"
#: What the Bronze header needs.
HEADER_DDL = "struct<info:struct<city:string,dates:array<string>,gender:string,match_type:string,season:string,teams:array<string>,venue:string>>"
#: What teams, venues and competitions need.
NAMES_DDL = "struct<info:struct<city:string,event:struct<name:string,`group`:string>,teams:array<string>,team_type:string,venue:string>>"
METADATA = ("_snapshot_date", "_ingested_at", "_pipeline_run_id", "_dag_run_id", "_source_file", "_source_url")
BRONZE_COLUMNS = ("match_id", "revision", "match_type", "gender", "season", "match_date", "team_a", "team_b", "venue", "city", "raw_json")
