"""Word lists, emoji, templates and name candidates.

These must equal the published task definition for results to agree, so they
are stated plainly. Every operator takes them as parameters.
"""

# --- labels -----------------------------------------------------------------
POSITIVE, NEGATIVE, ABSTAIN = 1, 0, -1

# --- column-name candidates ---------------------------------------------------
TEXT_NAMES = ["review", "text", "content", "评论", "内容"]
LABEL_NAMES = ["label", "sentiment", "rating", "标签", "情感"]
TEXT_SUBSTRINGS = ["text", "review", "content", "评论", "内容"]
LABEL_SUBSTRINGS = ["label", "labels", "sentiment", "sentiment_label", "polarity", "rating", "评分", "类别", "情感"]

# --- stop words ---------------------------------------------------------------
STOPWORDS_14 = ["的", "了", "和", "是", "我", "也", "很", "在", "有", "就", "都", "不", "人", "这"]
STOPWORDS_28 = [
    "的", "了", "在", "是", "我", "有", "和", "就", "不", "人", "都", "一", "一个", "上", "也",
    "很", "到", "说", "要", "去", "你", "会", "着", "没有", "看", "好", "自己", "这",
]

# --- keyword labels -------------------------------------------------------------
GENERAL_POS = ["好", "不错", "满意", "推荐", "喜欢", "优秀", "棒", "赞", "快", "美味", "干净", "舒适"]
GENERAL_NEG = ["差", "不好", "失望", "垃圾", "烂", "难吃", "脏", "慢", "糟糕", "投诉"]
TAKEAWAY_POS = ["好吃", "美味", "推荐", "满意", "快"]
TAKEAWAY_NEG = ["难吃", "差", "慢", "冷", "贵"]
DICTIONARY_POS = ["好", "棒", "快", "新鲜", "满意", "赞", "喜欢"]
DICTIONARY_NEG = ["慢", "差", "坏", "脏", "失望", "破损", "不满意"]

# --- labelling functions ----------------------------------------------------------
SERVICE_POS = ["热情", "周到", "贴心", "专业", "及时", "耐心"]
SERVICE_NEG = ["态度差", "不耐烦", "敷衍", "冷淡", "拖延"]
ENVIRONMENT_POS = ["干净", "整洁", "舒适", "温馨", "宽敞", "明亮"]
ENVIRONMENT_NEG = ["脏", "乱", "吵", "潮湿", "破旧", "狭小"]
NEGATORS = ["不", "没", "无", "非", "别", "莫"]
NEGATED_POS = ["好", "满意", "推荐", "喜欢", "优秀", "棒"]
SHORT_POS = ["好", "赞", "棒", "不错", "优秀", "满意"]
SHORT_NEG = ["差", "烂", "垃圾", "难吃", "失望"]
EXCLAMATION_NEG = ["差", "烂", "垃圾", "失望", "投诉", "退款"]
COMPARISON_POS = ["更好", "最好", "最棒", "更优", "更满意"]
COMPARISON_NEG = ["更差", "最差", "更烂", "不如"]
EMOJI_POS = ["😊", "😄", "👍", "❤️", "💕", "😍", "🙂", "😁"]
EMOJI_NEG = ["😞", "😡", "👎", "💔", "😠", "🤮", "😭"]
RECOMMEND_POS = ["推荐", "值得", "建议", "可以试试", "不错的选择"]
RECOMMEND_NEG = ["不推荐", "不建议", "别买", "慎买", "谨慎"]

# --- bias slice, policy ------------------------------------------------------------
BIAS_WORDS = ["地区", "性别", "方言", "表情"]
POLICY_RULES = {"差": 0, "脏": 0, "失望": 0, "赞": 1}
POLICY_THRESHOLD = 0.7

# --- augmentation -----------------------------------------------------------------
SYNONYMS = {
    "好吃": ["美味", "可口", "好味", "香"],
    "难吃": ["难以下咽", "糟糕", "不好吃"],
    "快": ["迅速", "及时", "速度快"],
    "慢": ["缓慢", "速度慢", "很久"],
    "好": ["棒", "赞", "不错", "优秀"],
    "差": ["糟", "烂", "不行"],
    "贵": ["昂贵", "价格高"],
    "便宜": ["实惠", "价格低"],
    "满意": ["开心", "高兴", "舒服"],
    "不满意": ["失望", "难受", "生气"],
    "新鲜": ["鲜", "干净"],
    "不新鲜": ["旧", "不干净", "脏"],
}
CHAR_SYNONYMS = {"快": ["迅速", "飞快"], "好": ["棒", "优秀"], "慢": ["迟缓", "拖沓"]}
TYPO_PAIRS = [("的", "得"), ("了", "啦"), ("吗", "嘛"), ("呢", "哪"), ("在", "再"), ("做", "作")]
CHAR_TYPOS = {"的": ["地", "得"], "了": ["啦", "喽"]}
EMOJI_BY_WORD = [
    ("好吃", "😋"), ("难吃", "🤮"), ("快", "⚡"), ("慢", "🐌"), ("好", "👍"),
    ("差", "👎"), ("满意", "😊"), ("不满意", "😠"), ("推荐", "💯"), ("不推荐", "❌"),
]
EMOJI_CLASSES = [("[😀😃😄😁]", "笑"), ("[😢😭]", "哭"), ("[👍]", "赞")]
REWRITES = [("(.*)(很|非常|特别)(.*)", "$1$3$2"), ("！", "。"), ("太", "")]

# --- prompt texts ------------------------------------------------------------------
LABEL_WORDS = {1: "正面", 0: "负面"}
SENTIMENT_SYSTEM = (
    "你是一个专业的中文情感分析助手。请根据给定的评论文本，判断其情感倾向。\n"
    '输出格式：仅输出"正面"或"负面"，不要有任何额外解释。'
)
EXAMPLES_HEADER = "以下是一些示例：\n\n"
EXAMPLE_FORMAT = "评论：{text}\n情感：{label}\n\n"
QUESTION_FORMAT = "现在请判断以下评论的情感：\n评论：{text}\n情感："
DOMAIN_ASPECTS = {
    "hotel": "服务、环境、位置、设施、价格、卫生",
    "food": "口味、配送、包装、价格、分量、卫生",
    "ecommerce": "质量、价格、物流、包装、外观、功能",
}
DEFAULT_ASPECTS = "服务、质量、价格等"
ASPECT_USER = "请分析以下评论的方面级情感：\n\n{text}"
ERROR_FALLBACK_REASON = "未知"
ERROR_FALLBACK_FIX = "需要进一步分析"
ASPECT_SYSTEM = """你是一个专业的方面级情感分析（ABSA）专家。请从评论中提取（方面词，观点词，情感极性）三元组。

**任务说明：**
- 方面词（Aspect）：评论关注的具体方面，如{aspects}
- 观点词（Opinion）：描述方面的具体表达，如"很好"、"太差"、"一般"等
- 情感极性（Sentiment）：正面/负面/中性

**输出格式：**
严格按照JSON数组格式输出，例如：
[
  {"aspect": "服务", "opinion": "态度很好", "sentiment": "正面"},
  {"aspect": "价格", "opinion": "偏贵", "sentiment": "负面"}
]

**注意事项：**
1. 如果没有明确的方面词，使用"整体"作为方面词
2. 如果同一方面有多个观点，分别提取
3. 只输出JSON，不要有任何额外解释
"""
CASE_HEADER = "**当前误判样本：**\n文本：{text}\n真实标签：{true}\n预测标签：{pred}\n\n**相似误判案例（共{n}条）：**\n"
CASE_FORMAT = "\n{rank}. 文本：{text}...\n   真实：{true} | 预测：{pred} | 相似度：{similarity}\n"
CASE_FOOTER = "\n请分析这个误判案例的原因。"
