"""Vocabularies, patterns, weights and thresholds. Every operator takes them as parameters."""

from __future__ import annotations

# Labels, patterns, weights and limits that define the expected results.
LABELS = ("sub_diseases", "symptoms", "tests", "treatments", "plans")
NOISE_LINES = (
    r"中国实用外科杂志\s*20\d{2}年\d+月第\d+卷第\d+期",
    r"中华.*杂志\s*20\d{2}",
    r"(?i)Chin\s+J.*?(Vol\.|No\.)",
    r"^\s*[·•・]?\s*\d+\s*[·•・]?\s*$",
    r"^\s*\d+(?:\s+\d+)+\s*$",
    r"^\s*指南与共识\s*$",
    r"^\s*20\d{2}[）)]\s*$",
    r"(?i)^\s*(通信作者|Corresponding\s+authors?)[:：]",
    r"^\s*(收稿日期|本文编辑|引用本文)[:：]?",
    r"(?i)DOI[:：]?\s*10\.\d{4,9}/[^\s]+",
    r"(?i)\b10\.\d{4,9}/[^\s]+",
)
TAILS = (
    r"(?m)^\s*执笔\s*[:：]",
    r"(?m)^\s*编写组成员\s*[（(]?.*?[:：]",
    r"(?m)^\s*诊疗规范撰写组名单\s*[（(]?.*?[:：]",
    r"(?m)^\s*指南制定组名单\s*[（(]?.*?[:：]",
    r"(?m)^\s*专家组名单\s*[（(]?.*?[:：]",
    r"(?m)^\s*[（(]\s*按姓氏汉语拼音排\s*\n\s*序\s*[）)]\s*[:：]\s*$",
    r"(?m)^\s*所有作者均声明不存在利益冲突\s*$",
    r"[（(]\s*收稿[日期日][^）)]*[）)]",
    r"[（(]\s*本文编辑[^）)]*[）)]",
    r"(?m)^\s*参\s*考\s*文\s*献\s*$",
    r"(?m)^\s*考\s*文\s*献\s*$",
    r"(?m)^\s*(?:[0-9０-９一二三四五六七八九十]+[\.．、\s]*)?参考文献\s*$",
    r"(?im)^\s*(?:[0-9０-９]+[\.．、\s]*)?references\s*$",
    r"(?m)^\s*[［\[]\s*1\s*[］\]]",
)
FRONT_MARKERS = ("Guidelines", "Keywords", "关键词", "中图分类号", "文献标志码", "MedicalAssociation")
BODY_STARTS = (r"(?m)^急性胰腺炎指", r"(?m)^[一-鿿]{2,30}指因")
QUALITY = {"min_text_chars": 80, "max_cjk_ratio": 0.02, "min_ascii_letter_ratio": 0.20, "min_readable_ratio": 0.55, "max_weird_ratio": 0.35}
THRESHOLDS = {"sub_diseases": 0.35, "symptoms": 0.30, "tests": 0.30, "treatments": 0.35, "plans": 0.35}
ALPHA = 5.0
VOTE_WEIGHTS = {"medical_pattern": 1.2, "prompted_llm": 1.1, "dictionary": 0.9, "regex_indicator": 0.6, "section_prior": 0.4}
PRIMARY = ("medical_pattern", "prompted_llm", "dictionary")
COUNT_WEIGHTS = {"medical_pattern": 1.2, "prompted_llm": 0.9, "dictionary": 0.8, "regex_indicator": 0.8, "section_prior": 0.0}
FLOOR_LFS = ("medical_pattern", "dictionary", "regex_indicator")
MAX_COUNT = {"sub_diseases": 5, "symptoms": 30, "tests": 30, "treatments": 10, "plans": 20}
ACCEPT, REVIEW, MIN_GAP, LOW_RECALL = 0.65, 0.40, 0.15, 0.10
ENTITY_TYPES = ("diseases", "sub_diseases", "symptoms", "tests", "treatments", "plans", "etiologies", "pathogeneses")
RELATIONS = (  # relation, source type, target type, greatest chunk distance, quota for each sub-disease
    ("has_sub_disease", "diseases", "sub_diseases", 0, None),
    ("manifests_as", "sub_diseases", "symptoms", 2, 3),
    ("requires_test", "sub_diseases", "tests", 2, 3),
    ("follows_treatment", "sub_diseases", "treatments", 1, 1),
    ("implements_by", "treatments", "plans", 1, None),
    ("causes", "etiologies", "sub_diseases", 2, 1),
    ("explained_by", "sub_diseases", "pathogeneses", 2, 1),
)
MAX_DISTANCE = 6
SENTENCE_ENDS = "。！？；;.!?"
TITLE_MARKERS = (
    "诊断和治疗指南", "诊断与治疗指南", "诊治指南", "诊疗指南", "防治专家共识", "防治指南", "治疗指南", "专家共识",
    "诊疗规范", "防治规范", "管理推荐", "临床路径", "指南", "共识", "规范",
)
SCOPE_PREFIXES = ("中国", "中华", "我国")
SUSPICIOUS_TOKENS = ("vs.", "RR", "CI", "P=", "P<", "g/d", "mg", "%")
GENERIC_SECTIONS = ("正文", "前言", "摘要", "关键词", "引言", "概述", "背景")

TERMS = {
    "sub_diseases": ("原发性", "继发性", "确诊", "诊断为", "分型", "亚型"),
    "symptoms": ("发热", "乏力", "疼痛", "皮疹", "口干", "眼干", "腹痛", "腹泻", "关节痛", "血栓形成", "流产"),
    "tests": ("CRP", "C反应蛋白", "PCT", "ESR", "血沉", "ANA", "抗体", "抗SSA", "抗SSB", "唇腺活检", "评分", "阳性", "阴性"),
    "treatments": ("治疗原则", "治疗目标", "规范治疗", "合理诊治", "控制炎症"),
    "plans": ("治疗方案", "药物治疗", "随访", "减量", "诱导缓解", "维持缓解"),
}
PATTERNS = {
    "sub_diseases": (
        ("diagnosis_name", r"(诊断为|确诊为|疑诊|可诊断为|又称)[^\n。；;]{0,30}", 0.72),
        ("classification", r"(分为|分型为|分型|亚型|临床类型)[^\n。；;]{0,40}", 0.70),
        ("disease_abbreviation", r"[一-鿿A-Za-z]{2,20}[（(][A-Za-z]{2,12}[）)]", 0.66),
    ),
    "symptoms": (
        ("manifestation_context", r"(表现为|临床表现|症状|体征|可出现|常见|首发症状)[^\n。；;]{0,50}", 0.78),
        ("symptom_surface", r"[一-鿿]{0,8}(溃疡|疼痛|困难|皮疹|红斑|结节|瘢痕|出血|发热|乏力)[一-鿿]{0,8}", 0.72),
        ("organ_involvement", r"[一-鿿]{1,12}(受累|损害|病变)[^\n。；;]{0,30}", 0.70),
    ),
    "tests": (
        ("test_context", r"(检查|检测|试验|评分|指数|阳性|阴性|升高|降低)[^\n。；;]{0,40}", 0.74),
        ("pathology_or_imaging", r"(组织病理学|病理|活检|CT|MRI|超声|影像学|实验室)[^\n。；;]{0,40}", 0.74),
    ),
    "treatments": (
        ("treatment_principle", r"(治疗原则|治疗目标|推荐意见|应控制|应避免|首选|规范治疗)[^\n。；;]{0,50}", 0.76),
        ("management_principle", r"(管理原则|综合管理|个体化治疗|控制炎症|预防复发)[^\n。；;]{0,50}", 0.72),
    ),
    "plans": (
        ("treatment_plan", r"(治疗方案|给予|使用|采用|联合|加用|减量|疗程|剂量)[^\n。；;]{0,60}", 0.76),
        ("follow_up_plan", r"(随访|复查|监测|每\d+[周月年]|间隔\d+[周月年])[^\n。；;]{0,50}", 0.72),
    ),
}
PRIORS = {
    "sub_diseases": (("诊断", 0.42), ("分型", 0.44), ("分类", 0.42), ("临床类型", 0.44), ("诊疗要点", 0.38)),
    "symptoms": (("临床表现", 0.45), ("症状", 0.45), ("体征", 0.45), ("表现", 0.40), ("受累", 0.38)),
    "tests": (("检查", 0.45), ("辅助检查", 0.45), ("实验室", 0.45), ("指标", 0.42), ("评分", 0.40), ("诊断标准", 0.42), ("分类标准", 0.42)),
    "treatments": (("治疗原则", 0.45), ("治疗", 0.38), ("管理", 0.36), ("推荐意见", 0.40)),
    "plans": (("治疗方案", 0.45), ("治疗", 0.38), ("用药", 0.42), ("随访", 0.40), ("管理", 0.36)),
}
SURFACE = {
    "tests": (r"检查", r"检测", r"培养", r"抗体", r"CRP", r"PCT", r"ESR", r"MRI", r"CT", r"PET"),
    "treatments": (r"治疗原则", r"治疗策略", r"处理原则", r"管理", r"推荐"),
    "plans": (r"mg", r"g/", r"每日", r"每[0-9一二三四五六七八九十]+", r"方案", r"手术", r"用药"),
    "etiologies": (r"病因", r"风险因素", r"危险因素", r"诱因", r"感染", r"病原体"),
    "pathogeneses": (r"机制", r"病理", r"生理", r"炎症", r"免疫", r"导致"),
    "symptoms": (r"症状", r"体征", r"发热", r"疼痛", r"皮疹", r"乏力", r"肿大"),
    "sub_diseases": (r"型$", r"期$", r"综合征", r"感染", r"炎", r"病", r"瘤"),
    "diseases": (r"指南", r"共识", r"诊疗规范", r"疾病"),
}
SURFACE_STRUCTURAL = {
    "etiologies": (r"(病因|诱因|触发因素|诱发因素|危险因素|风险因素|相关因素|病原体)", r"(导致|诱发|引起|增加.*风险|可能为.*因素|可为.*因素)"),
    "plans": (
        r"(mg|g|ml|每日|每晚|每周|疗程|冲击治疗|序贯|逐渐减量|口服|注射|鞘内注射)",
        r"(甲泼尼龙|泼尼松|秋水仙碱|沙利度胺|环磷酰胺|硫唑嘌呤|环孢素|甲氨蝶呤|TNF|干扰素)",
    ),
    "treatments": (r"(治疗目标|治疗原则|治疗策略|基础治疗|一般治疗|局部治疗|全身药物治疗)", r"(控制|防止|预防|改善|推荐|建议).{0,20}(治疗|管理|处理)"),
    "pathogeneses": (r"(发病机制|病理生理|机制|炎症级联|免疫反应|血管炎|结构改变|代谢改变)", r"(以.*为基础|由于.*引起|病理.*过程)"),
}
SURFACE_NEGATIVE = {
    "symptoms": (r"(病因|诱因|触发因素|诱发因素|危险因素|风险因素|病原体)", r"(治疗目标|治疗原则|治疗策略|mg|每日|疗程|冲击治疗|序贯|逐渐减量)"),
    "diseases": (r"(病因未明|诱因|触发因素|危险因素|治疗目标|治疗原则|mg|每日|疗程)",),
    "pathogeneses": (r"(病因未明|诱因|触发因素|危险因素|病原体)",),
}
CONTEXT = {
    "symptoms": ("症状", "体征", "表现", "临床"),
    "tests": ("检查", "检测", "诊断", "指标", "培养"),
    "treatments": ("治疗", "原则", "推荐", "处理"),
    "plans": ("方案", "剂量", "用法", "疗程", "手术"),
    "etiologies": ("病因", "风险", "危险因素", "诱发", "病原"),
    "pathogeneses": ("机制", "病理", "生理", "免疫", "炎症"),
    "sub_diseases": ("诊断", "分型", "亚型", "类型"),
    "diseases": ("指南", "共识", "规范", "疾病"),
}
CONTEXT_STRUCTURAL = {
    "etiologies": (r"(可能为|可为|属于|是).{0,20}(触发因素|诱发因素|诱因|危险因素|风险因素)", r"(病因|诱因|触发因素|诱发因素|危险因素|风险因素|病原体)"),
    "plans": (r"(mg|每日|每晚|疗程|冲击治疗|序贯|逐渐减量|口服|注射|鞘内注射)", r"(秋水仙碱|沙利度胺|甲泼尼龙|泼尼松|环磷酰胺|硫唑嘌呤|甲氨蝶呤)"),
    "treatments": (r"(治疗目标|治疗原则|治疗策略|基础治疗|一般治疗|局部治疗|全身药物治疗)",),
    "pathogeneses": (r"(发病机制|病理生理|机制|血管炎|免疫反应|炎症)",),
}
CONTEXT_NEGATIVE = {"symptoms": (r"(触发因素|诱发因素|诱因|危险因素|风险因素)", r"(治疗目标|治疗原则|治疗策略|mg|每日|疗程|冲击治疗)")}
#: Rows of a page: tokens whose base line has slipped, and tables without lines.
FLOATING_TOKEN = r"^[\dA-Za-z%~～≤≥<>.=+\-()/·：:，,；;［\]\[\s]+$"
CLOSED_ENDS = ("。", "）", ")", "：", ":")
COUNT_WORD = "合项"
TABLE_CAPTION = (
    r"^(?:表\s*)?\d+\s*(?:改良|急性胰腺炎.*(?:评分|系统|特点)|.*评分(?:标准|系统)|.*临床特点)"
    r"|^急性胰腺炎(?:分级诊断系统|局部并发症临床特点)$"
)
TABLE_BODY = r"^(?:特征\s*评分|分级系统|器官系统|评分|临床特点|感染性胰腺|[（(]4[）)]危重型)|^\d+分\d+分\d+分$"
TABLE_NUMBER = r"^\d+(?:\.\d+)?$"
TABLE_SYMBOL = r"[≤≥<>～~%]|mmHg|FiO2|PaO2|RAC|DBC|SAP|MAP|MSAP|WON|ANC|PP"
TABLE_SHORT = r"(胰腺炎性反应|正常胰腺|胰腺坏死|坏死范围|并发症|器官功能|呼吸系统|肾脏|心血管系统)"
TABLE_WORD = r"感染性胰腺|危重型急性胰腺炎|持续性器官功能障碍伴感染性|SOFA|发生于病程|包膜"
TABLE_NOTES = ("注：", "注:")
NARRATIVE = r"^(?:\d+(?:\.\d+)+|\d+\s+)[一-鿿]"
ADVICE = "推荐"
HEADING_TOKENS = ("vs.", "rr", "ci", "p<", "p=", "g/d", "mg", "mmol", "%")
NOISE_TITLES = (
    r"^(?:[0-9０-９一二三四五六七八九十]+[\.．、\s]*)?参考文献$",
    r"^(?:[0-9０-９]+[\.．、\s]*)?references$",
    r"^通信作者",
    r"^基金项目",
    r"^作者单位",
    r"^利益冲突",
    r"^\[\d+\]",
    r"^［\d+］",
)
CHUNK_NOISE = (
    ("doi", r"DOI[:：]?\s*10\.\d{4,9}/[^\s]+|10\.\d{4,9}/[^\s]+"),
    ("received", r"收稿日期"),
    ("cite_this", r"引用本文"),
    ("editor", r"本文编辑"),
    ("page_marker", r"<<PAGE"),
    ("page_number", r"^[•・]\s*\d+\s*[•・]?$"),
)
#: Objective findings, for an LF on tests alone.
INDICATORS = (
    ("antibody_status", r"(抗[\w一-鿿α-ωΑ-ΩⅠ-Ⅻ/-]{1,24}抗体|ANA|aCL|LAC|抗SSA|抗SSB)[^\n。；;，,]{0,18}(阳性|阴性|\+|-)", 0.86),
    ("lab_value", r"(?i)\b(CRP|PCT|ESR|ANA|APTT|dRVVT|IgG|IgM|IgA)\b[^\n。；;，,]{0,18}(≥|≤|>|<|=|升高|降低|阳性|阴性)?\s*\d+(?::\d+)?(?:\.\d+)?\s*(?:mg/L|ng/ml|mm/h|g/L|U/ml|GPL|MPL|%)?", 0.84),
    ("score_threshold", r"(Mayo|UCEIS|OSS|SLEDAI|ESSDAI|评分|指数|活动性指数)[^\n。；;，,]{0,20}(≥|≤|>|<|=|达到|高于|低于)?\s*\d+(?:\.\d+)?", 0.82),
    ("exam_item", r"(活检|造影|超声|CT|MRI|内镜|病理|组织学|血清学|实验室检查|影像学检查|针刺反应)", 0.72),
    ("diagnostic_threshold", r"(至少|满足|符合)[^\n。；;]{0,18}([一二三四五六七八九十\d]+)项[^\n。；;]{0,18}(诊断|分类标准|标准)", 0.78),
)
#: What OCR may find that a page's own text lacks.
OCR_BLOCK = r"(?:(?<![\d.])[123]\s*急性胰腺炎|推荐\s*\d+\s*[:：])"
OCR_ADVICE = r"^\s*推荐\s*(\d+)\s*[:：]"
OCR_STRENGTH_MARK = r"推荐强度\s*[:：]"
OCR_STRENGTH = r"推荐强度\s*[:：]\s*(?:强|一般)\s*[)）]?"
OCR_NOISE = r"[A-Za-z]{1,2}|[、。，]{2,}"
OCR_FOOTER = r"(?i)China Academic Journal Electronic Publishing House|cnki\.net"
OCR_HEADINGS = ("1 急性胰腺炎的诊断", "2 急性胰腺炎的治疗", "3 急性胰腺炎病人的随访")
OCR_BEFORE = {"1": r"^\s*1\.4\s*急性胰腺炎的影像学检查"}
SECTION_TERMS = {
    "symptoms": ("临床表现", "症状", "体征"),
    "tests": ("检查", "诊断", "实验室", "辅助检查"),
    "treatments": ("治疗", "处理", "管理"),
    "plans": ("治疗", "方案", "用药"),
    "etiologies": ("病因", "危险因素", "流行病学"),
    "pathogeneses": ("发病机制", "病理", "机制"),
    "sub_diseases": ("分型", "诊断", "分类"),
}
TRIGGERS = {
    "manifests_as": ("表现", "症状", "体征", "临床", "可见", "出现", "伴有"),
    "requires_test": ("检查", "检测", "培养", "诊断", "指标", "阳性", "阴性", "升高", "降低"),
    "follows_treatment": ("治疗", "原则", "推荐", "处理", "管理", "应", "建议"),
    "implements_by": ("治疗", "方案", "药", "剂量", "疗程", "手术", "操作"),
    "causes": ("病因", "危险因素", "风险", "导致", "诱发", "相关", "易感", "病原"),
    "explained_by": ("机制", "病理", "生理", "由于", "引起", "过程", "解释"),
}
PLAN_PATTERNS = (
    r"\b\d+(\.\d+)?\s*(mg|g|ml|μg|ug)\b",
    r"(每日|每周|每月|每晚|每次|1次|2次|3次|bid|tid|qd|q[0-9]+h)",
    r"(口服|注射|静脉|肌内|皮下|玻璃体内|关节腔内|鞘内)",
    r"(冲击治疗|序贯|逐渐减量|减少.*剂量|短期抗凝|随访|疗程)",
    r"(甲泼尼龙|泼尼松|秋水仙碱|环磷酰胺|硫唑嘌呤|英夫利西单抗|阿达木单抗|曲安奈德)",
)
DISEASE_MODIFIERS = ("急性", "慢性", "重症", "轻症", "轻型", "中型", "中度", "重型", "复杂性", "单纯性", "原发性", "继发性")
ORGAN_ENDING = r"^([一-鿿]{2,6})(?:炎|感染|综合征|病|症)$"
UNIT = r"(?:c\s*f\s*u|cfu)\s*[／/]\s*m\s*l"
UNIT_IN_OCR = r"(?i)(?:[>≥=]\s*)?10\s*(?:\^)?([3-9])\s*(?:c\s*f\s*u|[ce]\s*f\s*u|c\s*f\s*a)\s*[／/x]?\s*m?\s*l?"
BY_SEX = r"[^\d>，,、。]{0,8}>?10(?:\^)?([3-9])"
CAPTION = r"(?i)^\s*(表\s*\d+|图\s*\d+|Table\s*\d+|Figure\s*\d+)"
NOTE = r"(?i)^\s*(注[:：]|注释[:：]|Note:|Notes:)"
YES, NO = ("1", "true", "yes", "y", "on"), ("0", "false", "no", "n", "off")
EDIT_KEYS = ("noise_spans", "translation_spans")
WHOLE_SECTION, PREFACE = "正文", "前言/概述"

# What the demonstration queries look for in texts without Chinese.
DEMO_TERMS = {
    "sub_diseases": ("tion", "heit", "ment"), "symptoms": ("the", "der", "que", "los"), "tests": ("ing", "ung", "eau"),
    "treatments": ("anth", "sch", "oi"), "plans": ("ere", "lich", "ado"),
}
DEMO_PATTERNS = {
    "sub_diseases": (("capital", r"[A-Z][a-z]+tion", 0.72), ("ending", r"[a-z]+ment", 0.66)), "symptoms": (("short", r"[aeiou]th[aeiou]", 0.78),),
    "tests": (("digits", r"[0-9]{4,}", 0.74), ("mail", r"[a-z]+@[a-z0-9.]+", 0.70)), "treatments": (("double", r"nn|ll|ss", 0.76),), "plans": (("verb", r"er[a-z]*ing", 0.72),),
}
DEMO_PRIORS = {
    "sub_diseases": (("The", 0.42), ("on", 0.44)), "symptoms": (("er", 0.45),), "tests": (("ing", 0.45), ("st", 0.40)), "treatments": (("re", 0.38),), "plans": (("en", 0.42),),
}
