"""Record schemas, allowed values and fixed constants of the data contract."""

from __future__ import annotations


# ---- Fixed values: thresholds, rates and buffer sizes ------------------------------------------
LOW_STOCK_BELOW = 10  # catalogue rows alert below this
ORDER_LOW_STOCK_UPTO = 10  # order rows alert up to and including this
STALE_AFTER_MS = 60 * 60 * 1000
SNAPSHOT_EVERY_MS = 5 * 60 * 1000
SESSION_GAP_MS = 30 * 60 * 1000
CART_TTL_MS = 2 * 60 * 60 * 1000
# Fixed values of the data contract: what a rejected checkout says.
MISSING_SESSION = "Session ID is missing."
NO_CART = "Cart not found."
EMPTY_CART = "Cart is empty"

TAX_RATE = "0.08"
SHIPPING = "5.99"
FREE_SHIPPING_OVER = 50
CHAT_BUFFER = 10
POINT_BUFFER = 150
RECOMMENDATION_BUFFER = 5
PRICE_HISTORY = 10
READINGS_HISTORY = 100

# ---- Fixed values: topic names -----------------------------------------------------------------
TOPIC_PRODUCTS = "products"
TOPIC_PRODUCT_UPDATES = "product-updates"
TOPIC_INVENTORY_EVENTS = "inventory-events"
TOPIC_INVENTORY_ALERTS = "inventory-alerts"
TOPIC_UI_FANOUT = "websocket_fanout"
TOPIC_ORDER_EVENTS = "order-events"
TOPIC_PROCESSING_FANOUT = "processing_fanout"

# ---- Fixed values: enumerations ----------------------------------------------------------------
INVENTORY_EVENT_TYPES = (
    "PRODUCT_ADDED", "PRODUCT_UPDATED", "INVENTORY_INCREASED", "INVENTORY_DECREASED",
    "OUT_OF_STOCK", "BACK_IN_STOCK", "PRICE_CHANGED", "LOW_STOCK_ALERT", "STALE_INVENTORY",
    "SALE_STARTED",
)
TRACKED_EVENT_TYPES = (
    "PAGE_VIEW", "PRODUCT_VIEW", "PRODUCT_SEARCH", "ADD_TO_CART", "REMOVE_FROM_CART",
    "UPDATE_CART_QUANTITY", "CART_VIEW", "CHECKOUT_START", "CHECKOUT_COMPLETE",
    "PAYMENT_PROCESSED", "ORDER_PLACED", "RECOMMENDATION_VIEWED", "RECOMMENDATION_CLICKED",
    "USER_LOGIN", "USER_LOGOUT", "WISHLIST_ADD", "WISHLIST_REMOVE", "REVIEW_SUBMITTED",
    "CATEGORY_BROWSE",
)
ENVELOPE_TYPES = (
    "CHAT_MESSAGE", "RANDOM_NUMBER_POINT", "ONLINE_USERS", "GEO_COORDINATE", "ECOMMERCE_EVENT",
    "SHOPPING_CART", "PRODUCT_UPDATE", "RECOMMENDATION", "ORDER_UPDATE",
)
CHAT_TYPES = ("USER_JOINED", "USER_LEFT", "CHAT_MESSAGE", "LANGUAGE_SET")
LANGUAGES = (
    "EN", "AR", "BN", "ZH", "FR", "DE", "HI", "ID", "JA", "PA", "PT", "RU", "ES", "TR", "VI",
    "DEFAULT",
)
RECOMMENDATION_TYPES = (
    "FREQUENTLY_BOUGHT_TOGETHER", "SIMILAR_ITEMS", "TRENDING_NOW", "PERSONALIZED",
    "NEXT_BEST_OFFER", "ABANDONED_CART_RECOVERY",
)

# ---- Records as they arrive in JSON --------------------------------------------------------------
PRODUCT = (
    "productId STRING, name STRING, description STRING, price DOUBLE, category STRING, brand STRING, "
    "imageUrl STRING, inventory INT, tags ARRAY<STRING>, rating DOUBLE, reviewCount INT"
)
ORDER_ITEM = ("orderId STRING, productId STRING, quantity INT, timestamp BIGINT")
CHANGE_RECORD = (
    "op STRING, ts_ms BIGINT, source STRUCT<table: STRING>, after STRUCT<order_item_id: BIGINT, "
    "order_id: STRING, product_id: STRING, quantity: STRING, unit_price: DOUBLE, discount: DOUBLE, "
    "line_total: DOUBLE>"
)
INVENTORY_EVENT = (
    "productId STRING, productName STRING, eventType STRING, previousInventory INT, currentInventory INT, "
    "previousPrice DOUBLE, currentPrice DOUBLE, timestamp BIGINT, changeReason STRING, alertLevel STRING"
)
ALERT = (
    "alertType STRING, productId STRING, message STRING, severity STRING, timestamp BIGINT"
)
TRACKED_EVENT = (
    "eventId STRING, sessionId STRING, userId STRING, eventType STRING, timestamp BIGINT, productId STRING, "
    "categoryId STRING, value DOUBLE, quantity INT, searchQuery STRING, metadata MAP<STRING,STRING>, "
    "referrer STRING, userAgent STRING, ipAddress STRING, page STRING, title STRING, productName STRING, "
    "resultCount INT, recommendationId STRING, cartTotal DOUBLE, itemCount INT, orderId STRING, "
    "categoryName STRING, totalAmount DOUBLE, category STRING"
)
CART_LINE = (
    "productId STRING, productName STRING, price DOUBLE, quantity INT, subtotal DOUBLE, imageUrl STRING, "
    "addedAt BIGINT"
)
CHAT = (
    "id STRING, userId STRING, type STRING, message STRING, timestamp BIGINT, toUserId STRING, "
    "translations MAP<STRING,STRING>"
)
BASKET_RECOMMENDATION = (
    "sessionId STRING, userId STRING, recommendationType STRING, recommendedProducts ARRAY<STRING>, "
    "confidence DOUBLE, timestamp BIGINT, triggerEvent STRING, context MAP<STRING,STRING>"
)
ENVELOPE = (
    "uuid STRING, timestamp BIGINT, key STRING, toUserId STRING, eventType STRING, payload STRING"
)
