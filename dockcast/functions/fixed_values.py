"""Fixed values that must equal the source system's for identical results.

They are data (lookup tables and constants), stated here as given, in their
original order. Everything else in the package is parameterised.
"""

# City name → romanised city name (unmapped → "N/A").
CITY_NAMES = {
    "新北市": "XinBeiShi",
    "台北市": "TaiBeiShi",
    "台中市": "TaiZhongShi",
    "高雄市": "GaoXiongShi",
    "桃園市": "TaoYuanShi",
    "臺南市": "TaiNanShi",
    "嘉義市": "JiaYiShi",
    "屏東縣": "PingDongXian",
    "新竹市": "XinZhuShi",
    "新竹縣": "XinZhuXian",
    "苗栗縣": "MiaoLiXian",
    "新竹科學工業園區": "XinZhuKeXueGong",
}

# Area name → romanised area name (unmapped → "N/A").
# Two areas share "LuZhuQu"; never group by the romanised area alone.
AREA_NAMES = {
    "竹北市": "ZhuBeiShi", "後龍鎮": "HouLongZhen", "左鎮區": "ZuoZhenQu", "楠西區": "NanXiQu",
    "后里區": "HouLiQu", "松山區": "SongShanQu", "中山區": "ZhongShanQu", "文山區": "WenShanQu",
    "大安區": "DaAnQu", "信義區": "XinYiQu", "中正區": "ZhongZhengQu", "南區": "NanQu",
    "安南區": "AnNanQu", "善化區": "ShanHuaQu", "通霄鎮": "TongXiaoZhen", "汐止區": "XiZhiQu",
    "安定區": "AnDingQu", "東區": "DongQu", "三重區": "SanChongQu", "仁德區": "RenDeQu",
    "北投區": "BeiTouQu", "蘆竹區": "LuZhuQu", "八德區": "BaDeQu", "茄萣區": "QieDingQu",
    "林園區": "LinYuanQu", "三民區": "SanMinQu", "湖內區": "HuNeiQu", "中和區": "ZhongHeQu",
    "板橋區": "BanQiaoQu", "歸仁區": "GuiRenQu", "楠梓區": "NanZiQu", "烏日區": "WuRiQu",
    "永康區": "YongKangQu", "佳里區": "JiaLiQu", "左營區": "ZuoYingQu", "旗山區": "QiShanQu",
    "新化區": "XinHuaQu", "西港區": "XiGangQu", "鹽水區": "YanShuiQu", "新營區": "XinYingQu",
    "鶯歌區": "YingGeQu", "土城區": "TuChengQu", "八里區": "BaLiQu", "永安區": "YongAnQu",
    "鼓山區": "GuShanQu", "中西區": "ZhongXiQu", "橋頭區": "QiaoTouQu", "台北維調區": "TaiBeiWeiDiaoQu",
    "前鎮區": "QianZhenQu", "大樹區": "DaShuQu", "岡山區": "GangShanQu", "苓雅區": "LingYaQu",
    "路竹區": "LuZhuQu", "霧峰區": "WuFengQu", "士林區": "ShiLinQu", "新竹科學園區": "XinZhuKeXueYuanQu",
    "潮州鎮": "ChaoZhouZhen", "竹田鄉": "ZhuTianXiang", "車城鄉": "CheChengXiang", "林邊鄉": "LinBianXiang",
    "麟洛鄉": "LinLuoXiang", "維調區": "WeiDiaoQu", "恆春鎮": "HengChunZhen", "東港鎮": "DongGangZhen",
    "屏東市": "PingDongShi", "關廟區": "GuanMiaoQu", "學甲區": "XueJiaQu", "新市區": "XinShiQu",
    "麻豆區": "MaDouQu", "後壁區": "HouBiQu", "柳營區": "LiuYingQu", "東山區": "DongShanQu",
    "官田區": "GuanTianQu", "安平區": "AnPingQu", "玉井區": "YuJingQu", "白河區": "BaiHeQu",
    "北區": "BeiQu", "六甲區": "LiuJiaQu", "北門區": "BeiMenQu", "七股區": "QiGuQu",
    "下營區": "XiaYingQu", "大內區": "DaNeiQu", "山上區": "ShanShangQu", "美濃區": "MeiNongQu",
    "甲仙區": "JiaXianQu", "維護調度中心": "WeiHuTiaoDuZhongXin", "燕巢區": "YanChaoQu", "阿蓮區": "ALianQu",
    "彌陀區": "MiTuoQu", "大社區": "DaSheQu", "大寮區": "DaLiaoQu", "鳥松區": "NiaoSongQu",
    "仁武區": "RenWuQu", "梓官區": "ZiGuanQu", "小港區": "XiaoGangQu", "旗津區": "QiJinQu",
    "鳳山區": "FengShanQu", "前金區": "QianJinQu", "鹽埕區": "YanChengQu", "新興區": "XinXingQu",
    "市區": "ShiQu", "臨時站": "LinShiZhan", "維修調度中心": "WeiXiuTiaoDuZhongXin", "測試站": "CeShiZhan",
    "竹南鎮": "ZhuNanZhen", "苑裡鎮": "YuanLiZhen", "新社區": "XinSheQu", "外埔區": "WaiPuQu",
    "和平區": "HePingQu", "石岡區": "ShiGangQu", "龍井區": "LongJingQu", "潭子區": "TanZiQu",
    "大雅區": "DaYaQu", "大肚區": "DaDuQu", "神岡區": "ShenGangQu", "梧棲區": "WuQiQu",
    "東勢區": "DongShiQu", "大甲區": "DaJiaQu", "沙鹿區": "ShaLuQu", "清水區": "QingShuiQu",
    "太平區": "TaiPingQu", "大里區": "DaLiQu", "豐原區": "FengYuanQu", "北屯區": "BeiTunQu",
    "南屯區": "NanTunQu", "西屯區": "XiTunQu", "西區": "XiQu", "新豐鄉": "XinFengXiang",
    "中區": "ZhongQu", "湖口鄉": "HuKouXiang", "竹東鎮": "ZhuDongZhen", "香山區": "XiangShanQu",
    "觀音區": "GuanYinQu", "龜山區": "GuiShanQu", "龍潭區": "LongTanQu", "楊梅區": "YangMeiQu",
    "桃園區": "TaoYuanQu", "新屋區": "XinWuQu", "平鎮區": "PingZhenQu", "中壢區": "ZhongLiQu",
    "大溪區": "DaXiQu", "大園區": "DaYuanQu", "猴雙公共自行車專區": "HouShuangGongGongZiXingCheZhuanQu",
    "新北維調區": "XinBeiWeiDiaoQu", "蘆洲區": "LuZhouQu", "樹林區": "ShuLinQu", "雙溪區": "ShuangXiQu",
    "新莊區": "XinZhuangQu", "新店區": "XinDianQu", "萬里區": "WanLiQu", "瑞芳區": "RuiFangQu",
    "淡水區": "DanShuiQu", "深坑區": "ShenKengQu", "泰山區": "TaiShanQu", "林口區": "LinKouQu",
    "坪林區": "PingLinQu", "金山區": "JinShanQu", "永和區": "YongHeQu", "石門區": "ShiMenQu",
    "石碇區": "ShiDingQu", "五股區": "WuGuQu", "三峽區": "SanXiaQu", "三芝區": "SanZhiQu",
    "臺大公館校區": "TaiDaGongGuanXiaoQu", "萬華區": "WanHuaQu", "南港區": "NanGangQu", "內湖區": "NeiHuQu",
    "大同區": "DaTongQu", "苗栗市": "MiaoLiShi", "頭份市": "TouFenShi",
}

# Weather zones (name, latitude, longitude) requested hourly.
WEATHER_ZONES = [
    ("TaiBei", 25.05, 121.54),
    ("XinBei", 25.01, 121.46),
    ("TaoYuan", 24.98, 121.28),
    ("XinZhu", 24.81, 120.99),
    ("MiaoLi", 24.57, 120.70),
    ("TaiZhong", 24.14, 120.67),
    ("JiaYi", 23.47, 120.44),
    ("TaiNan", 22.99, 120.20),
    ("GaoXiong", 22.63, 120.32),
    ("PingDong", 22.67, 120.48),
]

# Timestamp text formats (Spark datetime patterns) — run
# stamps in file names, and timestamps as the SQL store receives them.
FILE_TS_FORMAT = "yyyy-MM-dd_HH:mm:ss"
DB_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Operating constants.
LOCAL_TZ = "Asia/Taipei"
STALE_DAYS = 8               # snapshots updated before midnight of today − 8 days are stale
FRESH_MINUTES = 5            # status / forecast freshness
SNAPSHOT_MINUTES = 10        # snapshot cadence: 3 rows ≈ 30 min, 12 rows ≈ 120 min
LAG_ROWS = 3
ROLLING_ROWS = 12
HORIZON_MINUTES = 30
