"""National organization names, successors and parents.

These are reference facts, kept as plain tables; results depend on the exact names.
"""

from .names import Authority

MISSING_TOKENS = ("", "null", "NULL", "None", "none", "undefined", "-")

RULE_TYPE_ROOTS = {
    "대통령훈령": "대통령",
    "국무총리훈령": "국무총리",
}

ALIASES = {
    "10.29이태원참사진상규명과재발방지를위한특별조사위원회": "10·29이태원참사진상규명과재발방지를위한특별조사위원회",
    "건설교통부": "국토교통부",
    "교육인적자원부": "교육부",
    "교육과학기술부": "교육부",
    "결제정책팀": "금융위원회",
    "국가과학기술위원회": "국가과학기술자문회의",
    "국가균형발전위원회": "지방시대위원회",
    "국무총리2": "국무총리",
    "국무총리실": "국무조정실",
    "국민안전처": "행정안전부",
    "국립환경인력개발원": "국립환경인재개발원",
    "국토해양부": "국토교통부",
    "기획재정부": "재정경제부",
    "행정자치부": "행정안전부",
    "노동부": "고용노동부",
    "농림부": "농림축산식품부",
    "농림수산부": "농림축산식품부",
    "농림수산식품부": "농림축산식품부",
    "대통령실": "대통령비서실",
    "문화관광부": "문화체육관광부",
    "문화재청": "국가유산청",
    "문화재청(구)": "국가유산청",
    "미래창조과학부": "과학기술정보통신부",
    "방송통신사무소": "방송미디어통신사무소",
    "방송통신위원회": "방송미디어통신위원회",
    "보건복지가족부": "보건복지부",
    "산업자원부": "산업통상부",
    "산업통상자원부": "산업통상부",
    "소방방재청": "소방청",
    "식품의약품안전청": "식품의약품안전처",
    "안전행정부": "행정안전부",
    "여성가족부": "성평등가족부",
    "외교통상부": "외교부",
    "정보통신부": "과학기술정보통신부",
    "중소기업청": "중소벤처기업부",
    "중앙민방위방재교육원": "국가재난안전교육원",
    "국가민방위재난안전교육원": "국가재난안전교육원",
    "지식경제부": "산업통상부",
    "통계청": "국가데이터처",
    "통상산업부": "산업통상부",
    "특허청": "지식재산처",
    "평생교육진흥원": "국가평생교육진흥원",
    "환경부": "기후에너지환경부",
    "환경부(구)": "기후에너지환경부",
}

SUCCESSORS = {
    "문교부": ("교육부",),
    "교육인적자원부": ("교육부",),
    "교육과학기술부": ("교육부", "과학기술정보통신부",),
    "노동부": ("고용노동부",),
    "외교통상부": ("외교부",),
    "국토해양부": ("국토교통부", "해양수산부", "기후에너지환경부",),
    "지식경제부": ("산업통상부",),
    "정보통신부": ("과학기술정보통신부",),
    "문화관광부": ("문화체육관광부",),
    "안전행정부": ("행정안전부",),
    "보건복지가족부": ("보건복지부", "성평등가족부",),
    "농림부": ("농림축산식품부",),
    "농림수산부": ("농림축산식품부", "해양수산부",),
    "농림수산식품부": ("농림축산식품부", "해양수산부",),
}

DEPARTMENT_OVERRIDES = (
    ("교육부", "과학기술정보통신부"),
    ("국토교통부", "해양수산부"),
    ("국토교통부", "기후에너지환경부"),
    ("농림축산식품부", "해양수산부"),
    ("보건복지부", "성평등가족부"),
    ("산업통상부", "기후에너지환경부"),
)

STALE_DEPARTMENTS = (
    ("과학기술정보통신부", "방송미디어통신위원회", "과학기술정보통신부"),
    ("기후에너지환경부", "국토교통부", "기후에너지환경부"),
)

PARENTS = {
    "감사원": "대통령",
    "개인정보보호위원회": "국무총리",
    "검찰청": "법무부",
    "경찰청": "행정안전부",
    "고위공직자범죄수사처": "대통령",
    "공정거래위원회": "국무총리",
    "관세청": "재정경제부",
    "국가교육위원회": "대통령",
    "국가과학기술자문회의": "대통령",
    "국가데이터처": "국무총리",
    "국가보훈부": "국무총리",
    "국가유산청": "문화체육관광부",
    "국가인권위원회": "대통령",
    "국가정보원": "대통령",
    "국가재난안전교육원": "행정안전부",
    "국가평생교육진흥원": "교육부",
    "국립기상과학원": "기상청",
    "국립농산물품질관리원": "농림축산식품부",
    "국립산림과학원": "산림청",
    "국립재난안전연구원": "행정안전부",
    "국립전파연구원": "과학기술정보통신부",
    "국립환경과학원": "기후에너지환경부",
    "국립환경인재개발원": "기후에너지환경부",
    "국무조정실": "국무총리",
    "국무총리비서실": "국무총리",
    "국민권익위원회": "국무총리",
    "국세청": "재정경제부",
    "금융감독원": "금융위원회",
    "금융위원회": "국무총리",
    "기상청": "기후에너지환경부",
    "기획예산처": "국무총리",
    "납북피해자보상및지원심의위원회": "통일부",
    "농촌진흥청": "농림축산식품부",
    "대검찰청": "법무부",
    "대통령경호처": "대통령",
    "대통령비서실": "대통령",
    "민주평화통일자문회의사무처": "대통령",
    "방송미디어통신사무소": "방송미디어통신위원회",
    "방송미디어통신위원회": "대통령",
    "방위사업청": "국방부",
    "법제처": "국무총리",
    "병무청": "국방부",
    "산림청": "농림축산식품부",
    "새만금개발청": "국토교통부",
    "삼청교육피해자명예회복및보상심의위원회": "국무총리",
    "소방청": "행정안전부",
    "수도권매립지관리공사": "기후에너지환경부",
    "식품의약품안전처": "국무총리",
    "우주항공청": "과학기술정보통신부",
    "원자력안전위원회": "국무총리",
    "인사혁신처": "국무총리",
    "재외동포청": "외교부",
    "전파관리소": "중앙전파관리소",
    "전파시험인증센터": "국립전파연구원",
    "조달청": "재정경제부",
    "중앙선거관리위원회": "대통령",
    "중앙전파관리소": "과학기술정보통신부",
    "지식재산처": "국무총리",
    "지방시대위원회": "대통령",
    "질병관리청": "보건복지부",
    "특별감찰관": "대통령",
    "해양경찰청": "해양수산부",
    "행정중심복합도시건설청": "국토교통부",
    "위성전파감시센터": "중앙전파관리소",
}

ROOTS = (
    "대통령",
    "국무총리",
    "교육부",
    "외교부",
    "통일부",
    "법무부",
    "국방부",
    "행정안전부",
    "문화체육관광부",
    "농림축산식품부",
    "산업통상부",
    "보건복지부",
    "기후에너지환경부",
    "고용노동부",
    "성평등가족부",
    "국토교통부",
    "해양수산부",
    "중소벤처기업부",
    "재정경제부",
    "과학기술정보통신부",
    "국가인권위원회",
    "중앙선거관리위원회",
    "고위공직자범죄수사처",
    "진실화해를위한과거사정리위원회",
    "세월호 선체조사위원회",
    "친일반민족행위자재산조사위원회",
    "10·29이태원참사진상규명과재발방지를위한특별조사위원회",
)

NATIONAL = Authority(
    missing=MISSING_TOKENS, aliases=ALIASES, successors=SUCCESSORS, overrides=DEPARTMENT_OVERRIDES,
    stale=STALE_DEPARTMENTS, parents=PARENTS, roots=ROOTS, rule_roots=RULE_TYPE_ROOTS,
)
