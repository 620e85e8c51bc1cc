"""Hand-made source documents."""

import json


def bill(number, kind, congress, updated, title, sponsors=(), cosponsors=(), committees=(), votes=(), area=None, text_date=None):
    """One bill file. A list with one entry is written as a lone child, as the source does."""

    def people(tag, ids):
        inner = "".join(f"<item><bioguideId>{i}</bioguideId><fullName>N {i}</fullName></item>" for i in ids)
        return f"<{tag}>{inner}</{tag}>" if ids else ""

    items = "".join(
        f"<item><systemCode>{c}</systemCode><name>{n}</name><chamber>{ch}</chamber></item>" for c, n, ch in committees
    )
    actions = "<item><actionDate>2023-01-09</actionDate><text>Introduced</text></item>" + "".join(
        f"<item><actionDate>{d[:10]}</actionDate><recordedVotes><recordedVote><rollNumber>{r}</rollNumber><url>{u}</url>"
        f"<chamber>{ch}</chamber><congress>{congress}</congress><date>{d}</date><sessionNumber>{2 - int(d[:4]) % 2}</sessionNumber></recordedVote></recordedVotes></item>"
        for r, u, ch, d in votes
    )
    including = f"<updateDateIncludingText>{text_date}</updateDateIncludingText>" if text_date else ""
    policy = f"<policyArea><name>{area}</name></policyArea>" if area else ""
    return (
        f'<?xml version="1.0"?><billStatus><version>3.0.0</version><bill><number>{number}</number><updateDate>{updated}</updateDate>'
        f"{including}<type>{kind}</type><introducedDate>2023-01-09</introducedDate><congress>{congress}</congress>"
        f"<committees>{items}</committees><actions>{actions}</actions>{people('sponsors', sponsors)}{people('cosponsors', cosponsors)}"
        f"{policy}<subjects><legislativeSubjects><item><name>Budget</name></item></legislativeSubjects></subjects>"
        f"<summaries><summary><actionDate>2023-01-09</actionDate><text>Short</text></summary></summaries>"
        f"<title>{title}</title></bill></billStatus>"
    )


def house_roll(number, ballots, session="1st", congress=118, day="9-Jan-2023", result="Passed"):
    cast = "".join(
        f'<recorded-vote><legislator name-id="{i}" sort-field="S" unaccented-name="N" party="{p}" state="OR" role="legislator">Name</legislator>'
        f"<vote>{v}</vote></recorded-vote>"
        for i, p, v in ballots
    )
    totals = "".join(
        f"<totals-by-party><party>{name}</party><yea-total>{y}</yea-total><nay-total>{n}</nay-total><present-total>0</present-total>"
        f"<not-voting-total>0</not-voting-total></totals-by-party>"
        for name, y, n in (("Republican", 1, 2), ("Democratic", 3, 0), ("Independent", 0, 0))
    )
    return (
        f'<?xml version="1.0"?><rollcall-vote><vote-metadata><majority>R</majority><congress>{congress}</congress><session>{session}</session>'
        f"<chamber>U.S. House of Representatives</chamber><rollcall-num>{number}</rollcall-num><vote-question>On Passage</vote-question>"
        f'<vote-result>{result}</vote-result><action-date>{day}</action-date><action-time time-etz="16:20">4:20 PM</action-time>'
        f"<vote-totals>{totals}<totals-by-vote><total-stub>Totals</total-stub><yea-total>4</yea-total><nay-total>2</nay-total>"
        f"<present-total>0</present-total><not-voting-total>1</not-voting-total></totals-by-vote></vote-totals></vote-metadata>"
        f"<vote-data>{cast}</vote-data></rollcall-vote>"
    )


def senate_roll(number, ballots, congress=118):
    cast = "".join(
        f"<member><member_full>M</member_full><last_name>L</last_name><first_name>F</first_name><party>{p}</party><state>OR</state>"
        f"<vote_cast>{v}</vote_cast><lis_member_id>{i}</lis_member_id></member>"
        for i, p, v in ballots
    )
    return (
        f'<?xml version="1.0"?><roll_call_vote><congress>{congress}</congress><session>1</session><vote_number>{number}</vote_number>'
        f"<vote_date>February 3, 2023,  05:30 PM</vote_date><question>On the Motion</question><vote_result>Agreed to</vote_result>"
        f"<count><yeas>2</yeas><nays>1</nays><present/><absent>1</absent></count><members>{cast}</members></roll_call_vote>"
    )


def member(bioguide, name, party, terms, current=True, updated="2023-05-01T00:00:00Z", parties=None):
    shown = [dict(chamber=c, congress=g, district=d, startYear=s, endYear=e, stateCode="OR", stateName="Oregon", memberType="M") for c, g, d, s, e in terms]
    return json.dumps(
        {
            "bioguideId": bioguide, "firstName": "F", "lastName": name, "invertedOrderName": f"{name}, F", "currentMember": current,
            "birthYear": "1960", "depiction": {"imageUrl": f"http://img/{bioguide}"}, "updateDate": updated,
            "partyHistory": [{"partyName": p, "startYear": y} for p, y in (parties or [(party, 2001)])],
            "terms": [{k: v for k, v in t.items() if v is not None} for t in shown],
            "terms_all": {"item": [{k: v for k, v in (("chamber", c), ("startYear", s), ("endYear", e)) if v is not None} for c, _, _, s, e in terms]},
        }
    )


SENATORS = (
    "<?xml version='1.0'?><senators>"
    "<senator><full_name><first_name>F</first_name><last_name>Sen1</last_name></full_name><state>OR</state><bioguide>M4</bioguide><lisid>S4</lisid></senator>"
    "<senator><full_name><first_name>F</first_name><last_name>Sen2</last_name></full_name><state>OR</state><bioguide>M5</bioguide><lisid>S5</lisid><lisid>S50</lisid></senator>"
    "<senator><full_name><first_name>F</first_name><last_name>Nobody</last_name></full_name><state>OR</state><bioguide>M9</bioguide></senator>"
    "</senators>"
)
OVERRIDES = "first_name,last_name,state,bioguideID,lisid\rF,Sen1,OR,M4,S44"
STATES = "Name,Abbreviation\r\nOregon,OR \r\nWashington,WA \r\n"
ZONES = "zcta,state_abbr,cd\n97201,OR,1\n97201,OR,3\n97201,WA,3\n98101,WA,7\n"
