"""Messages as sites and tools show them, and short texts that are content, written before the rules they are judged by.

Texts with an even checksum were looked at while the rules were written; those with an odd one were only counted.
"""

import zlib

MESSAGES = """
We can't display this page right now.
We couldn't locate that page.
This lesson has not been available since May.
The page you asked for does not exist.
Diese Seite existiert nicht.
La page demandée n'est pas disponible.
Your request was blocked.
Verify you are human to continue.
This site can’t be reached. The connection was reset.
Sorry, you have been blocked. You are unable to access this website.
This content isn't available in your country.
The video is private. Sign in if you have been granted access to this video.
The link you followed may be broken, or the page may have been removed.
We're having trouble loading this page. Please refresh.
The server encountered an internal problem and could not complete your request.
Please complete the security check to access the site.
You don't have permission to view this directory.
The document has expired and must be requested again.
Our website is offline for scheduled work. We will be back shortly.
Your browser is out of date. Update it to view this site correctly.
An unexpected condition was encountered while processing the request.
This article hasn't been written yet. Come back soon.
The material for this unit will be published later.
Page intentionally left blank.
There is nothing here yet.
No description provided.
No results were returned for this query.
The requested URL was rejected. Please consult with your administrator.
Database connection failed: too many connections.
Your session timed out because of inactivity. Log in again.
This feature is disabled. Ask your administrator to switch it on.
The image could not be rendered because the file is corrupted.
Service temporarily overloaded, retry in a few minutes.
You have reached your download quota for today.
Enable cookies and reload the page.
This app needs scripting to be turned on in your browser.
Bitte aktivieren Sie Skripte in Ihrem Browser, um diese Seite zu sehen.
Die angeforderte Datei wurde verschoben oder gelöscht.
Der Server antwortet derzeit nicht. Versuchen Sie es später noch einmal.
Dieser Inhalt steht Ihnen nicht zur Verfügung.
Sie haben keine Berechtigung, diese Seite anzusehen.
Die Verbindung zum Server ist fehlgeschlagen.
Dieses Kapitel wird noch überarbeitet und bald veröffentlicht.
Votre navigateur bloque les cookies, activez-les pour continuer.
Le fichier que vous cherchez a été retiré du serveur.
Cette leçon sera publiée prochainement.
Vous n'avez pas l'autorisation de consulter cette page.
Le service est momentanément interrompu. Merci de revenir plus tard.
La conexión con el servidor se ha perdido.
El archivo solicitado ya no está en este servidor.
No tiene permiso para ver esta página.
Esta lección todavía no está lista. Vuelve más tarde.
El navegador debe aceptar cookies para mostrar el contenido.
A ligação ao servidor falhou. Tente mais tarde.
O ficheiro pedido foi removido do servidor.
Não tem permissão para aceder a esta página.
Esta aula ainda não foi publicada.
O seu navegador precisa de ter os scripts ativados.
यह पृष्ठ मौजूद नहीं है।
सर्वर से कनेक्शन टूट गया है, कृपया बाद में कोशिश करें।
आपको इस पृष्ठ को देखने की अनुमति नहीं है।
यह पाठ अभी तैयार नहीं है।
您没有权限查看此页面。
服务器连接失败，请刷新页面。
该课程内容正在准备中。
请求的文件已被移动。
您的浏览器不支持脚本，请开启后重试。
""".strip().splitlines()
CONTENT = """
The current does not change when the second lamp is removed.
A page of a book reflects light in all directions.
The connection between pressure and volume is not linear.
Water is missing from the dried sample, so its mass is smaller.
No force acts on the cart once the string is cut.
The cell cannot divide without energy.
This lesson explains why the sky is not green.
The unit of force is the newton, not the kilogram.
An error of two percent in the length gives four percent in the area.
The experiment failed because the lens was wet.
Remove the lid and wait until the solution cools down.
The server in a tennis match stands behind the base line.
Access of oxygen to the flame is blocked by the foam.
In the next chapter the material is heated again and again.
Der Strom ändert sich nicht, wenn die zweite Lampe entfernt wird.
Die Seite eines Würfels ist nicht länger als seine Diagonale.
La page du livre ne transmet pas la lumière.
Le courant est interrompu par le fusible.
La conexión en serie no cambia la corriente.
El contenido de agua no depende de la altura.
A ligação covalente não conduz corrente.
O conteúdo de sal foi removido por destilação.
पानी बिना ताप के नहीं उबलता।
电流不随时间改变。
Glossary: access time, the delay before a disk answers; session, the time a user stays connected.
Q: Which gas is missing in the list? A: Nitrogen is missing.
A browser sends a request to a server; if the server does not know the address, it answers with an error, which students often confuse with a lost connection.
The request of the king was denied, and the session of parliament ended.
The link of the chain is broken by a force of nine newtons.
Try the experiment again with a longer string and check the result.
""".strip().splitlines()
SLOT_TEXTS = """
Welcome back, [FIRST NAME], to the second part.
Hello |*FNAME*|, your results are ready.
Hello *|FNAME|*, your results are ready.
The course is taught by %(teacher)s in room 4.
Dear ___________,
Our lesson on [Insert topic] starts at ten.
Your mark: {grade_value} points of 20.
In this course the {user} pays attention to waves.
The lecture was held by [LECTURER_NAME] in May.
Chapter <CHAPTER TITLE> follows.
Contact: [your email address]
See page XX for the proof of ${theorem_title}.
""".strip().splitlines()


def half(texts, odd):
    return [t for t in texts if zlib.crc32(t.encode()) % 2 == odd]
